"""Contamination, token alignment and prefix tries against brute force: given tables, odd rows, planted cases."""

import random
from collections import Counter

import brute
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millpond.llm import decontamination, prefix_trie, token_alignment
from millpond.llm.common import Work
from millpond.llm.queries import QUERIES
from millpond.llm.queries.registry import rebuilt

SF = "/root/testdata/sf0.001"
BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LONG = "word " * 60_000 + "end of a very long text " * 2000
SCHEMA = "doc_id long, text string, words string, spans string, key long, pair long, id long, hash long"
ODD = [
    (1, "One two three four five six seven eight nine ten eleven"), (1, "One two three four five six seven eight nine ten eleven"),
    (2, None), (3, ""), (4, " \n\t "), (None, "x one TWO three four five six seven eight nine ten y"), (5, LONG), (6, "a" * 100_000),
    (7, "é中😀 x\x1cy <|endoftext|> z▁w  two  spaces <s> \x00 end"), (8, "solo"), (9, "very long text, end of a very long text!"),
]
ITEMS = [
    (0, "one two three four five six seven eight nine ten eleven twelve"), (10, "one two three four five six seven eight nine ten"),
    (2, None), (3, ""), (4, "..."), (5, "Solo"), (5, "end of a"), (None, "z w two"), (7, "x y"), (0, "a very long text end of a very long text end of"),
]


def docs_of(spark, cases):
    return spark.createDataFrame([(d, t, "w", "s", 1, 2, 3, 4) for d, t in cases], SCHEMA)


def contaminated(spark, docs, items, item_type="long"):
    found = decontamination.contaminated(docs, spark.createDataFrame(items, f"item_id {item_type}, text string, length string"))
    return Counter(
        (r.doc.doc_id, r.n_words, r.n_hit, len(r["items"]), brute.sha(",".join(r["items"])), r.n_hit > 0) for r in found.collect()
    )


@pytest.mark.parametrize("cases", [ODD, []])
@pytest.mark.parametrize("items", [ITEMS, []])
def test_contamination(spark, cases, items):
    found = contaminated(spark, docs_of(spark, cases), [(*i, "x") for i in items])
    assert found == Counter(brute.contaminated(cases, items))


def test_contamination_of_random_texts(spark):
    """Few words, so that passages overlap, repeat and nearly match at every length."""
    random.seed(11)
    text = lambda n: " ".join(random.choice("abc") for _ in range(n))
    items = [(f"i{i}", text(random.randint(0, 25))) for i in range(25)]
    cases = [(i, text(random.randint(0, 120)) + random.choice(items)[1] + text(5)) for i in range(60)]
    cases += [(100 + i, items[3][1]) for i in range(200)]
    found = contaminated(spark, docs_of(spark, cases), [(*i, "x") for i in items], "string")
    assert found == Counter(brute.contaminated(cases, items))


def test_every_window_keeps_a_group():
    """Whatever surrounds a window, the group it keeps is the same; long texts hash as short ones do."""
    random.seed(12)
    own = [random.choice(["a", "b", "cd"]) for _ in range(400)]
    hashes = decontamination.word_hashes(" ".join(own).encode())
    text = hashes * 0
    for length in range(1, 11):
        k, w = decontamination.shape(length)
        kept = set(decontamination.winnowed(hashes, text, length)[0].tolist())
        assert all(kept & set(range(i, i + w)) for i in range(400 - length + 1)) and k + w - 1 == length
    block, decontamination.BLOCK = decontamination.BLOCK, 7
    try:
        assert (decontamination.word_hashes(" ".join(own).encode()) == hashes).all()
    finally:
        decontamination.BLOCK = block


def test_op11(spark):
    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(i, "text").collect()]
        for t, i in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    found = Counter(tuple(r) for r in QUERIES["op11_decontamination"](spark, SF).collect())
    assert found == Counter(brute.contaminated(docs, items)) and any(r[-1] for r in found)


def tokens_of():
    """Tokens with their bytes, by the libraries alone."""
    tokenizer, model = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tokenizer.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def left(text):
        ids = tokenizer.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(byte_of[c] for c in tokenizer.id_to_token(i))) for i in ids]

    def right(text):
        pieces = [(i, model.id_to_piece(i)) for i in model.encode(text)]
        return [(i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]

    return left, right


@pytest.mark.parametrize("cases", [ODD, []])
@pytest.mark.parametrize("remembered, short, head", [(200_000, 24, 200_000), (2, 3, 5)])
def test_alignment(spark, monkeypatch, cases, remembered, short, head):
    monkeypatch.setattr(token_alignment, "_REMEMBERED", remembered)
    monkeypatch.setattr(token_alignment, "_SHORT", short)
    monkeypatch.setattr(token_alignment, "HEAD", head)
    found = token_alignment.aligned(docs_of(spark, cases), BYTES, PIECES)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    got = Counter((r.doc.doc_id, *(r[n] for n in names), brute.sha(r.groups) if r.n_a else r.groups) for r in found.collect())
    assert got == Counter(brute.alignments(cases, *tokens_of()))


def test_alignment_of_odd_texts(spark):
    cases = [c for c in ODD if c[0] not in (5, 6)] + [(20 + i, t) for i, t in enumerate(["a  b", " a", "a ", "中文 字", "x" * 300, "1 2\n3"])]
    found = token_alignment.aligned(docs_of(spark, cases), BYTES, PIECES)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    got = Counter((r.doc.doc_id, *(r[n] for n in names), brute.sha(r.groups) if r.n_a else r.groups) for r in found.collect())
    assert got == Counter(brute.alignments(cases, *tokens_of()))


def test_op12(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = Counter(tuple(r) for r in QUERIES["op12_token_alignment"](spark, SF).collect())
    assert found == Counter(brute.alignments(docs, *tokens_of()))


TURNS = "conv_id long, turn long, role string, text string, conv string, ids string, size string"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "c", "i", "s") for r in rows], TURNS)


def nodes_of(spark, rows, shards, change=lambda own: own):
    work = Work(spark)
    own, _ = prefix_trie.encoded(work, turns_of(spark, rows))
    found = prefix_trie.trie(work, work.staged(change(own), "sequences"), shards)
    digests = {r.node: r.ends_sha256 for r in prefix_trie.ends_digests(found.ends).collect()}
    nodes = found.nodes.collect()
    depth_of = {r.id: r.depth for r in nodes}
    assert all((r.parent is None) == (r.depth == 0) and (r.depth == 0 or depth_of[r.parent] == r.depth - 1) for r in nodes)
    return Counter(
        (r.conv, r.depth, r.parent_conv, r.n_convs, r.n_children, r.n_leaves, r.saved, digests.get(r.id, brute.sha(""))) for r in nodes
    )


def random_turns(seed, convs, turns, kinds):
    random.seed(seed)
    return [
        (c, t, random.choice(["user", None, ""]), random.choice([None, "", *(f"té{k}" * k for k in range(kinds))]))
        for c in range(convs) for t in range(random.randint(0, turns))
    ]


HOT = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
ODD_TURNS = [
    (5, None, None, None), (5, 0, "user", ""), (5, 0, "user", ""), (5, 0, "assistant", "ab"), (None, 0, "user", "lost"), (7, 1, "user", "x"),
    (-3, 0, "user", "below zero"), (-5, 0, "user", "base"), (9, 1, "a", "b:c"), (9, 2, "a:", "bc"), (2**62, 0, "user", LONG),
]


@pytest.mark.parametrize("shards", [1, 3, 17])
@pytest.mark.parametrize("rows", [
    [], ODD_TURNS, HOT + [(500, 0, "user", "turn 0")], random_turns(1, 200, 6, 2), random_turns(2, 60, 4, 30) + HOT,
], ids=["empty", "odd", "hot", "deep", "wide"])
def test_trie(spark, rows, shards):
    assert nodes_of(spark, rows, shards) == Counter(brute.prefix_nodes(brute.in_turns(rows)))
    assert nodes_of(spark, rows, shards, rebuilt) == Counter(brute.prefix_nodes(brute.rebuilt(brute.in_turns(rows))))


def test_ends_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    assert nodes_of(spark, HOT, 4) == Counter(brute.prefix_nodes(brute.in_turns(HOT)))


def test_medians_first_grows_a_balanced_tree():
    assert sorted(prefix_trie.medians_first(1000)) == list(range(1000))
    tree = prefix_trie.SearchTree()
    for i in prefix_trie.medians_first(1000):
        tree.insert([i], [1])
    reach = {tree.equal[0]: 1}
    for node in range(1, 1001):
        for links in (tree.low, tree.high):
            if links[node] >= 0:
                reach[links[node]] = reach[node] + 1
    assert max(reach.values()) == 10


def test_op13(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    found = Counter(tuple(r) for r in QUERIES["op13_prefix_trie"](spark, SF).collect())
    assert found == Counter(brute.prefix_nodes(brute.rebuilt(brute.in_turns(rows))))


def test_ranks_encode_as_the_library():
    """Texts of checked characters take the fast way, all others the library's; both give its ids."""
    vocabulary = token_alignment.vocabulary(BYTES)
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    random.seed(13)
    parts = ["ab", "c's", "é", "ß", " ", "  ", "\n", "\t", "1", "23", ".", "!?", "\x85", "\xa0", "中", "ɐ", "İ", "word", "schlich", "'ll", "<|endoftext|>"]
    texts = ["".join(random.choice(parts) for _ in range(80)) for _ in range(300)] + ["", " ", "x" * 5000, " " * 5000, "ab" * 900]
    assert vocabulary.encode(texts) == [tokenizer.encode(f" {t}", add_special_tokens=False).ids for t in texts]
    assert token_alignment._ranked(tokenizer, vocabulary.pieces) is not None
    assert not token_alignment._UNCHECKED.search("plain ßtext\n") and token_alignment._UNCHECKED.search("ɐ")
