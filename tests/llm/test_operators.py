"""Each operator on NULLs, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millpond.llm import ann, bpe, licenses, mixing, pii, quality_model, quality_rules, simhash, substrings, token_counts
from millpond.llm.common import Work, byte_words

RANKS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
LONG = "word " * 60_000 + "end of a very long text " * 2000
#: Names that the operators use for columns of their own.
CLASHES = ["id", "key", "size", "target", "copies", "spans", "ids", "piece", "n_words", "kept", "score", "print", "row", "rank"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def rows_of(*cases):
    return [(doc, text, lang, source, None, *CLASHES) for doc, text, lang, source in cases]


ODD = rows_of(
    (1, "one two three four five one two three", "en", "a"),
    (1, "one two three four five one two three", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, " \n\t ", "de", "a"),
    (None, "no identifier here a@b.example.org", "en", "a"),
    (5, LONG, "en", "b"),
    (6, "a" * 100_000, "en", "b"),
    (7, "é中😀 x\x1cy z w 1.2.3.4 +49 30 12345678", None, "a"),
    (8, "one two three four five one two three", "en", "ä"),
    (9, "Released under the MIT License.\nReleased under the MIT License.", "en", "ä"),
)


@pytest.fixture(scope="module", params=["odd", "empty"])
def docs(request, spark):
    return spark.createDataFrame(ODD if request.param == "odd" else [], SCHEMA)


def collected(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_words_of_long_texts_are_whole():
    random.seed(1)
    data = "".join(random.choice(["a", "bc", " ", "\n", "é", "\x0b", "\x1c"]) for _ in range(3000)).encode()
    for size in (1, 2, 7, 100, 5000):
        assert [w for some in byte_words(data, size) for w in some] == data.split()


def test_mixing(docs):
    found = collected(mixing.sampled(docs), "doc.doc_id", "doc.source", "size", "source_size", "target", "copies")
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(brute.words(r.text))
    targets = brute.mix_targets(sizes) if sizes else {}
    assert len(found) == docs.count()
    for _, source, _, total, target, copies in found:
        assert total == sizes[source] and target == pytest.approx(targets[source]) and 0 <= copies <= 3
        assert total or not copies
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(f[-1] for f in found)


def test_mixing_comes_near_every_target(spark):
    """Sources of very different sizes, one with a third of all rows; ranks over several ranges."""
    random.seed(2)
    cases = [(i, "w " * random.randint(0, 300), "hot" if i % 3 == 0 else f"s{i % 13}") for i in range(4000)]
    docs = spark.createDataFrame(cases, "doc_id long, text string, source string")
    rows = mixing.sampled(docs).select("doc.source", "size", "target", "copies").collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 600 for s, t in target.items())


def test_bpe(docs):
    encoding = bpe._encoding(RANKS, public_tokenizers.PATTERN)
    found = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=1 << 12, overlap=64)
    got = Counter((d, tuple(ids), bytes(b)) for d, ids, b in collected(found, "doc.doc_id", F.col("ids"), bpe.decoded("ids", RANKS)))
    assert got == Counter((d, tuple(encoding.encode_ordinary(t or "")), (t or "").encode()) for d, t in texts(docs))


def test_bpe_stitches_random_texts(spark):
    random.seed(3)
    encoding = bpe._encoding(RANKS, public_tokenizers.PATTERN)
    parts = ["ab", "c's", "é", " ", "  ", "1", ".", "\n", "՘", "中", "'ll", "x" * 30]
    cases = [(i, "".join(random.choice(parts) for _ in range(300))) for i in range(40)]
    docs = spark.createDataFrame(cases, "doc_id long, text string")
    found = dict(collected(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=50, overlap=16), "doc.doc_id", "ids"))
    assert found == {i: encoding.encode_ordinary(t) for i, t in cases}


def test_texts_are_encoded_once(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    found = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).select("ids", F.size("ids"), bpe.decoded("ids", RANKS))
    assert found._jdf.queryExecution().executedPlan().toString().count("ids_of(") == 1


def test_bytes_of_lists_of_ids():
    rng = random.Random(3)
    lists = [rng.choice([None, [], [rng.randrange(50_000) for _ in range(rng.randrange(9))]]) for _ in range(60)]
    tokens = bpe._token_bytes(RANKS).to_pylist()
    want = [b"".join(tokens[i] for i in ids or ()) for ids in lists]
    given = pa.array(lists, pa.list_(pa.int32()))
    for part in (slice(0, 60), slice(7, 40), slice(5, 5)):
        assert bpe._joined_bytes(given[part], RANKS).to_pylist() == want[part]


def test_bpe_pieces_start_where_chunks_agree():
    assert bpe.stitched([[0], [5, 9], [], [30]], [[7, 9], [11], [30], []]) == [(0, 0), (1, 9), (1, -1), (1, -1)]


def test_licenses(docs):
    found = collected(licenses.scanned(docs), "doc.doc_id", "licenses")
    assert len(found) == docs.count()
    for doc, matches in found:
        assert [(m.name, m.coverage) for m in matches] == ([("mit-line", 1.0)] * 2 if doc == 9 else [])


def longest_common(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        last = best[:]
        for j, y in enumerate(b):
            best[j + 1] = last[j] + 1 if x == y else max(last[j + 1], best[j])
    return best[-1]


def test_alignment_is_a_common_subsequence():
    random.seed(4)
    for _ in range(300):
        a, b = ([random.choice("abcdefghijklmnop") for _ in range(random.randint(0, 14))] for _ in "ab")
        pairs = licenses.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(a, b)
    unique = random.sample([str(i) for i in range(50)], 50)
    other = [w for w in unique if random.random() < 0.8]
    assert len(licenses.aligned(unique, other)) == len(other)  # all anchors: exact


def test_license_survives_edits():
    text = licenses.TEMPLATES["mit"].replace("free of charge", "at no cost").replace("Software", "Program", 1)
    found = licenses.matches("x y z. " * 50 + text + " more", {n: licenses._WORD.findall(t.lower()) for n, t in licenses.TEMPLATES.items()}, 0.8)
    assert [m[0] for m in found] == ["mit"] and 0.8 <= found[0][3] < 1


def test_copies_back_to_back_are_all_found():
    words = {n: licenses._WORD.findall(t.lower()) for n, t in licenses.TEMPLATES.items()}
    for name in ("all-rights-reserved", "mit-line", "isc", "bsd-2-clause"):
        for offset in (0, 1, 2, 5):
            for count in (4, 50):
                text = "x " * offset + " ".join([licenses.TEMPLATES[name]] * count)
                found = [m for m in licenses.matches(text, words, 0.8) if m[0] == name]
                length = len(licenses.TEMPLATES[name])
                starts = [2 * offset + i * (length + 1) for i in range(count)]
                assert [(m[1], m[3]) for m in found] == [(at, 1.0) for at in starts]


def test_licenses_are_told_apart():
    words = {n: licenses._WORD.findall(t.lower()) for n, t in licenses.TEMPLATES.items()}

    def names(text):
        return [m[0] for m in licenses.matches(text, words, 0.8)]

    for name, template in licenses.TEMPLATES.items():
        assert names(f"some words before. {template} and after") == [name]
    assert names("Licensed under CC BY-SA 4.0.") == ["cc-by-sa-4.0-short-line"]
    assert names("Licensed under the Apache License, Version 1.1") == ["apache-1.1-line"]
    assert names("Released under the BSD License.") == []
    notice = licenses.TEMPLATES["gpl-3.0-notice"]
    assert names(notice.replace("version 3", "version 2")) == ["gpl-2.0-notice"]
    assert names(notice.replace("GNU General", "GNU Lesser General")) == ["lgpl-3.0-notice"]
    assert names(notice.replace("GNU General", "GNU Affero General")) == ["agpl-3.0-notice"]
    assert names(licenses.TEMPLATES["gpl-3.0-line"].replace("version 3", "version 3.0")) == ["gpl-3.0-line"]
    assert names(licenses.TEMPLATES["gpl-3.0-line"].replace("GNU", "GNU Library")) == []
    assert names(notice.replace("program", "library")) == ["gpl-3.0-notice"]


def test_quality_model(docs, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (4, None), (None, 1), (7, 1), (9, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        found = collected(quality_model.scored(docs, known), "doc.doc_id", "held_out", "score", "predicted")
        assert len(found) == docs.count() and all(0 <= f[2] <= 1 and f[3] in (0, 1) for f in found)
        if docs.count():
            assert len({f[2] for f in found if f[0] == 1}) == 1


def test_contexts_are_counted_whole():
    rng = np.random.default_rng(1)
    lists = [rng.integers(0, quality_model.BUCKETS, n) for n in (0, 1, 2, 3, 40)]
    index = quality_model.index_vectors()
    sums = np.zeros(quality_model.BUCKETS * quality_model.DIMENSIONS)
    quality_model.add_contexts(sums, lists, index)
    want = np.zeros((quality_model.BUCKETS, quality_model.DIMENSIONS))
    for ids in lists:
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if i != j and abs(i - j) <= quality_model.REACH:
                    np.add.at(want[a], index[0][b], index[1][b])
    assert (sums.reshape(want.shape) == want).all()


def test_network_is_calibrated_and_repeatable():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 6))
    truth = 1 / (1 + np.exp(-2 * (x[:, 0] * x[:, 1] + x[:, 2])))
    y = (rng.random(3000) < truth).astype(int)
    scores = quality_model.Network(x[:2000], y[:2000]).scores(x[2000:])
    assert (scores == quality_model.Network(x[:2000], y[:2000]).scores(x[2000:])).all()
    for low in np.arange(0, 1, 0.25):
        own = (scores >= low) & (scores < low + 0.25)
        assert abs(scores[own].mean() - y[2000:][own].mean()) < 0.15
    assert quality_model.Network(x[:3], np.ones(3)).scores(x[:2]).tolist() == [0.8, 0.8]


def test_personal_data(docs):
    found = pii.personal_data(docs)
    got = Counter(collected(found, "doc.doc_id", pii.listed(F.col("spans"), pii.KINDS[:4])))
    assert got == Counter((d, brute.base_spans(t)) for d, t in texts(docs))
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in texts(docs))
    assert [t for d, t in texts(clean) if d is None] in ([], ["no identifier here [EMAIL]"])


def test_personal_data_in_random_texts(spark):
    random.seed(5)
    parts = ["a", "b.c", "@", "x@y", ".", "-", "1", "23", "256", "4111 1111 1111 1111", " ", "+", "(", ")", "é", "😀",
             "+49 30 12345678", "1.2.3.4", "\n", "_", "a@b.cd", "0"]
    cases = [(i, "".join(random.choice(parts) for _ in range(30))) for i in range(400)]
    cases += [(1000, "a." * 3000 + "@" + "b." * 5000 + "c"), (1001, "1" * 20_000), (1002, "1." * 5000), (1003, "+1 " * 3000)]
    docs = spark.createDataFrame(cases, "doc_id long, text string")
    found = collected(pii.personal_data(docs), "doc.doc_id", pii.listed(F.col("spans"), pii.KINDS[:4]))
    assert dict(found) == {i: brute.base_spans(t) for i, t in cases}


def test_terms_that_disclose_an_entity_go(spark):
    cases = [(i, f"words {i} here Zoltan Qwertz wrote zq@mail.example.org about thing{i} {'ab'[i % 2]}x") for i in range(6)]
    cases += [(10, "Zoltan likes tea and mentions words here about wrote"), (11, "clean text words here wrote about")]
    cases += [(100 + i, f"words here wrote about {i}") for i in range(200)]
    # a passage with an entity that is only ever copied proves nothing about its words
    cases += [(500 + i, "copied Passage by some@one.example.net again and again") for i in range(5)]
    found = dict(texts(pii.sanitised(spark.createDataFrame(cases, "doc_id long, text string"))))
    assert found[0] == "words 0 here [NAME]  wrote [EMAIL] about 0 "
    assert found[10] == "[NAME] likes tea and mentions words here about wrote" and found[11] == cases[7][1]
    assert found[500] == "copied Passage by [EMAIL] again and again" and found[150] == "words here wrote about 50"


def test_terms_far_from_an_entity_are_judged_by_document(spark):
    far = " ".join(f"words here {i}" for i in range(100))
    # in all ten documents of the entity, near it in four of them, and far off in the others
    cases = [(i, f"{'Zoltan ' if i < 4 else ''}wrote zq@mail.example.org no {i} {far} {'' if i < 4 else 'Zoltan'}") for i in range(10)]
    # only ever far off
    cases += [(20 + i, f"note {i} by far@mail.example.org {far} Quentin") for i in range(3)]
    # a term in six documents, three of them with the entity: 1 bit is left, also if rows repeat
    cases += [(30 + i, f"line {i} {'from ab@mail.example.org ' if i < 3 else ''}{far} Ulrike") for i in range(6)]
    cases += [cases[-1]] * 5
    cases += [(100 + i, f"words here wrote no note by line from {i}") for i in range(300)]
    found = dict(texts(pii.sanitised(spark.createDataFrame(cases, "doc_id long, text string"))))
    assert found[0] == f" wrote [EMAIL] no 0 {far} " and found[9] == f"wrote [EMAIL] no 9 {far} "
    assert found[22] == f"note 2 by [EMAIL] {far} " and found[31] == f"line 1 from [EMAIL] {far} [NAME]"
    assert found[35] == f"line 5 {far} [NAME]" and found[150] == cases[-250][1]


@pytest.mark.parametrize("path", [PIECES, public_tokenizers.path("byte_bpe_50k.json")])
def test_token_counts(docs, path):
    tokenizer = Tokenizer.from_file(path)
    got = Counter(collected(token_counts.count_tokens(docs, path), "doc.doc_id", "n_tokens"))
    assert got == Counter((d, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in texts(docs))


@pytest.mark.parametrize("path", [PIECES, public_tokenizers.path("byte_bpe_50k.json")])
def test_token_counts_of_odd_characters(spark, monkeypatch, path):
    random.seed(6)
    monkeypatch.setattr(token_counts, "HEAD", 20)  # most pre-tokens take the shuffled join
    parts = ["ab", "c'S", " ", "é", "é", "́", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|startoftext|>", "1", "22",
             ".", "!?", "中", "ſ", "İ", "Σ", "ß", "À", "\n", "\x0b", "'ll", "ﬀ", "🙂", "가", "<|endof", "×", "ÿ"]
    cases = [(i, "".join(random.choice(parts) for _ in range(60))) for i in range(200)]
    tokenizer = Tokenizer.from_file(path)
    docs = spark.createDataFrame(cases, "doc_id long, text string")
    got = dict(collected(token_counts.count_tokens(docs, path), "doc.doc_id", "n_tokens"))
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in cases}


def test_simhash(docs):
    found = simhash.near_duplicates(docs, words=3, lanes=1, radius=2, agreement=None)
    got = Counter(collected(found, "doc.doc_id", F.lower(F.hex("fingerprint")), "component_id"))
    rows = texts(docs)
    prints = [brute.fingerprint(t) for _, t in rows]
    labels = brute.components(prints, [10**9 if d is None else d for d, _ in rows]) if rows else []
    want = Counter((d, f"{p:016x}", None if c == 10**9 else c) for (d, _), p, c in zip(rows, prints, labels))
    assert got == want
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, None, 5, 6, 7, 9] if rows else [])


def test_bit_slices_link_what_pairs_would():
    rng = np.random.default_rng(0)
    for count, centres, flips in ((1500, 1, 30), (900, 8, 30), (3000, 1, 25), (700, 700, 4)):
        prints = rng.integers(0, 256, (centres, 32), dtype=np.uint8)[rng.integers(0, centres, count)].copy()
        for row in prints:
            for bit in rng.integers(0, 256, rng.integers(0, flips)):
                row[bit // 8] ^= 1 << (bit % 8)
        bits = np.unpackbits(prints, axis=1).astype(int)
        near = bits @ (1 - bits.T) + (1 - bits) @ bits.T <= 20
        label = np.arange(count)
        while True:
            new = np.array([label[row].min() for row in near])
            new = new[new]
            if (new == label).all():
                break
            label = new
        assert (simhash.linked(prints, 20) == label).all()


def test_links_of_buckets_are_those_of_their_pairs():
    rng = np.random.default_rng(1)
    sizes = [2, 60, 300, 2, 2, 700, 3]
    held, want, nodes = [], set(), 0
    for size in sizes:
        prints = rng.integers(0, 256, (size, 64), dtype=np.uint8)
        for row in range(1, size, 2):  # a copy with up to 120 flipped bits, in a pair with the row before
            flipped = rng.choice(512, rng.integers(0, 121), replace=False)
            bits = np.unpackbits(prints[row - 1])
            bits[flipped] ^= 1
            prints[row] = np.packbits(bits)
            want.add((nodes + row, nodes + row - 1))
        held.append((list(range(nodes, nodes + size)), [p.tobytes() for p in prints]))
        nodes += size
    batch = pa.RecordBatch.from_pydict({"nodes": [n for n, _ in held], "prints": [p for _, p in held]})
    for rows in (1, 2, len(sizes)):
        found = simhash._bucket_links([batch.slice(at, rows) for at in range(0, len(sizes), rows)], 120)
        assert {(a, b) for part in found for a, b in zip(part["a"].to_pylist(), part["b"].to_pylist())} == want


def test_more_nodes_do_not_need_many_more_tables():
    for nodes, most in ((200_000, 50), (2_400_000, 50), (30_000_000, 100)):  # 64 nodes a bucket took 50, 123, 242
        tables = simhash.sampled_tables(512, nodes, 0.8)
        assert len(tables) <= most
        assert 1 - (1 - 0.8 ** len(tables[0])) ** len(tables) >= 0.97
        assert nodes / 2 ** len(tables[0]) <= simhash.TILE


def test_no_pair_within_the_radius_misses_a_block():
    random.seed(7)
    tables = simhash.block_tables(64, 2)
    assert len(tables) == 6
    for _ in range(200):
        flipped = random.sample(range(64), 2)
        assert any(not set(flipped) & set(t) for t in tables)


def test_large_buckets_are_cut_into_tiles(spark):
    """Equal key blocks in all prints: one bucket, many tiles, the same components."""
    from millpond.llm.common import Work

    random.seed(8)
    prints = list({random.getrandbits(14) for _ in range(700)})
    nodes = spark.createDataFrame([(i, bytearray(p.to_bytes(8, "big"))) for i, p in enumerate(prints)], "node long, print binary")
    work = Work(spark)
    edges = simhash.links(work, nodes, simhash.block_tables(64, 2), 2, tile=100)
    roots = {r.node: r.root for r in simhash.components(work, edges).collect()}
    assert [roots.get(i, i) for i in range(len(prints))] == brute.components(prints, list(range(len(prints))))


def test_long_chains_are_one_component(spark):
    from millpond.llm.common import Work

    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 400)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(Work(spark), edges).collect()}
    assert roots == {i: 0 for i in range(1, 201)} | {500: 400}


def test_near_duplicates_are_confirmed_by_their_shingles(spark):
    rng = random.Random(9)

    def text(n):
        return " ".join(f"w{rng.getrandbits(40)}" for _ in range(n))

    def own_words(line):
        return f"{text(304)} " + f"{line} " * 20

    line, one = text(10), text(400)
    cases = [(1, own_words(line)), (2, own_words(line))]  # a repeated line is all they share
    cases += [(3, one), (4, f"{one} " + f"{one[:200]} " * 30)]  # a copy, and the copy with a line repeated
    cases += [(5, one.upper()), (6, None), (7, "")]
    found = simhash.deduplicated(spark.createDataFrame(cases, "doc_id long, text string"))
    assert {r.doc_id for r in found.collect()} == {1, 2, 3, 6}


def test_isolated_pairs_at_the_threshold_are_found(spark):
    rng = random.Random(11)

    def words(n):
        return [f"w{rng.getrandbits(40)}" for _ in range(n)]

    cases = []
    for pair in range(400):
        # 396 shingles each: 352 of 440 in common, or 351 of 441
        one, other = words(400), 44 if pair < 300 else 45
        cases += [(2 * pair, " ".join(one)), (2 * pair + 1, " ".join(one[:-other] + words(other)))]
    kept = {r.doc_id for r in simhash.deduplicated(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    assert sum(2 * pair + 1 in kept for pair in range(300)) <= 4  # 0.84 were found within 86 bits
    assert all(2 * pair + 1 in kept for pair in range(300, 400)) and all(2 * pair in kept for pair in range(400))


def test_sets_in_tiles_link_what_pairs_would(spark):
    from millpond.llm.common import Work

    rng = random.Random(10)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[a : a + rng.randint(15, 40)]) for a in (rng.randint(0, 20) for _ in range(60))]
    sets = [set(simhash.shingle_set(t, 2).tolist()) for t in texts]
    rows = [(7, i, bytearray(8), len(sets[i]), t) for i, t in enumerate(texts)]
    members = spark.createDataFrame(rows, "root long, node long, print binary, n_shingles long, text string")
    label = list(range(60))
    for _ in range(60):
        label = [min(label[j] for j in range(60) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for i in range(60)]
    for most in (7, 100):
        work = Work(spark)
        edges = simhash.confirmed_links(work, members, 2, 0, 0.8, most=most)
        roots = {r.node: r.root for r in simhash.components(work, edges).collect()}
        assert [roots.get(i, i) for i in range(60)] == label


def test_quality_rules(docs, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1)], "doc_id long, quality int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter(collected(quality_rules.judged(docs, labels), "doc.doc_id", *names, "base_failed", "kept"))
    want = Counter()
    for d, t in texts(docs):
        s = brute.rule_stats(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want[(d, *s, failed, not failed)] += 1
    assert got == want


def test_rule_statistics_of_random_texts():
    random.seed(9)
    for _ in range(200):
        text = "".join(random.choice(["a", "b", "c ", " ", "\n", "# ", "|x", "é ", "\x0b", "\x1c"]) for _ in range(60))
        s = dict(zip(quality_rules._STATS, quality_rules.text_stats(text)))
        assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == brute.rule_stats(text)
    many = np.arange(3000) % 1500
    assert quality_rules.repeated_words(many, 1500) == quality_rules.repeated_words(many, 1 << 21) == 3000


def test_cutoffs_keep_their_promise():
    """Exact binomial: the bound itself, and the share of false rejections over many draws."""
    for n, share, level in ((500, 0.01, 0.05), (2000, 0.007, 0.002), (10, 0.01, 0.05)):
        k = quality_rules.most_losses(n, share, level)
        probabilities = np.cumsum([np.exp(np.sum(np.log(np.arange(n - i + 1, n + 1))) - np.sum(np.log(np.arange(1, i + 1)))
                                          + i * np.log(share) + (n - i) * np.log1p(-share)) for i in range(k + 2)])
        assert (k < 0 or probabilities[k] <= level) and probabilities[k + 1] > level
    rng, broken = np.random.default_rng(2), 0
    for _ in range(300):
        good = rng.multinomial(800, [0.9, 0.08, 0.015, 0.005])
        bad = rng.multinomial(200, [0.2, 0.2, 0.2, 0.4])
        cut = quality_rules.cutoff(np.arange(4), good, bad, 0.02, 0.05)
        broken += cut is not None and [1, 0.1, 0.02, 0.005][cut] > 0.02
    assert broken <= 0.05 * 300
    assert quality_rules.cutoff(np.array([0]), np.array([5]), np.array([0]), 0.02, 0.05) is None


def test_rules_reject_bad_texts_of_a_labelled_stratum(spark):
    random.seed(10)
    cases, labels = [], []
    for i in range(1600):
        bad = i % 8 == 0
        text = " ".join(f"w{random.randint(0, 10**6)}" + ("!!" if bad else "") for _ in range(60))
        cases.append((i, text, "en" if i % 2 == 0 or bad else "xx"))
        labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(cases, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int").where("doc_id < 1500")
    # some hundred labels allow cutoffs at a looser limit
    kept = {r.doc_id for r in quality_rules.judged(docs, known, alpha=0.3).where("kept").select("doc.doc_id").collect()}
    assert not [i for i, q in labels if q == 0 and i in kept] and len([i for i, q in labels if q == 1 and i in kept]) >= 1350


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, cell string, score string")


def test_nearest_neighbours_of_odd_vectors(spark):
    rows = [(i, [float(np.cos(i)), float(np.sin(i)), i % 3 - 1.0], "x", "y", "z") for i in range(60)]
    rows += [(60, None, "", "", ""), (61, [0.0, 0.0, 0.0], "", "", ""), (62, [1.0, None, 0.0], "", "", ""),
             (63, [float("nan"), 1.0, 0.0], "", "", ""), (64, [float("inf"), 1.0, 0.0], "", "", ""), (65, [1.0], "", "", ""),
             (None, [1.0, 0.0, 0.0], "", "", "")]
    rows += [(70, rows[0][1], "", "", ""), (70, rows[0][1], "", "", ""), (71, rows[0][1], "", "", "")]
    found = collected(ann.search(vectors_of(spark, rows), F.col("id") % 10 == 0), "query_id", "rank", "vec_id", "score")
    vectors = {r[0]: np.array(r[1], np.float32) for r in rows[:60] + rows[-3:]}
    for query in [0, 10, 20, 30, 40, 50, 70]:
        got = [(v, s) for q, rank, v, s in sorted(found) if q == query]
        want = brute.nearest(vectors, query)
        assert [v for v, _ in got] == [v for v, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=1e-12)
    assert {f[0] for f in found} == {0, 10, 20, 30, 40, 50, 70}
    assert ann.search(vectors_of(spark, []), F.col("id") % 10 == 0).collect() == []


def test_recall_and_tiles(spark, monkeypatch):
    """Random vectors, the hardest case, and a third of them equal; small tiles."""
    monkeypatch.setattr(ann, "ENTRIES", 300)
    monkeypatch.setattr(ann, "QUERIES", 10)
    rng = np.random.default_rng(3)
    points = rng.normal(size=(6000, 16))
    points[::3] = points[0]
    rows = [(i, [float(x) for x in p], "", "", "") for i, p in enumerate(points)]
    found = collected(ann.search(vectors_of(spark, rows), F.col("id") % 100 == 0), "query_id", "vec_id")
    unit = points.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hits = 0
    for query in range(0, 6000, 100):
        score = np.round(unit @ unit[query], 12)
        score[query] = -2
        hits += len(set(np.lexsort((np.arange(6000), -score))[:5]) & {v for q, v in found if q == query})
    assert hits >= 0.9 * 300


def test_cells_come_in_order_of_their_distance():
    rng = np.random.default_rng(4)
    a, b, sizes = rng.random(7), rng.random(5), rng.integers(0, 4, 35)
    cells = ann.traversed(a, b, sizes, 10**9)
    sums = (a[:, None] + b[None, :]).ravel()
    assert sorted(cells) == np.flatnonzero(sizes).tolist() and (np.diff(sums[cells]) >= 0).all()


def test_lines_repeated_many_times_give_ranges_in_proportion(spark):
    """Texts of one line, repeated 10, 15, 20, ... times: a range or two for each text, however many there are."""
    line = "a line that comes again and again "
    for count in (10, 20, 40, 80):
        cases = [(i, line * (10 + 5 * i) + f"end {i}") for i in range(count)]
        docs = spark.createDataFrame(cases, "id long, text string").withColumn("key", F.col("id"))
        ranges = substrings.repeated_ranges(Work(spark), docs)
        assert ranges.agg(F.sum(F.size("lows"))).first()[0] <= 30 * count
        found = substrings.without_repeats(docs, "id").select("doc.id", "n_words", "n_removed", F.sha2("kept", 256))
        assert Counter(map(tuple, found.collect())) == Counter(brute.without_repeats(cases))


def test_repeated_passages(docs):
    found = substrings.without_repeats(docs).select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert Counter(map(tuple, found.collect())) == Counter(brute.without_repeats(texts(docs)))


@pytest.mark.parametrize("crowd, shard, part", [(2000, 20_000, 40_000), (3, 20, 30)])
def test_repeated_passages_of_random_texts(spark, monkeypatch, crowd, shard, part):
    for name, value in (("CROWD", crowd), ("SHARD", shard), ("PART", part)):
        monkeypatch.setattr(substrings, name, value)
    random.seed(11)
    passages = [[random.choice("abcdefgh") for _ in range(60)] for _ in range(6)]
    cases = []
    for _ in range(120):
        own, low = random.choice(passages), random.randint(0, 40)
        own = own[low : low + random.randint(5, 60)]
        if random.random() < 0.5:
            own[random.randrange(len(own))] = f"zz{random.randint(0, 5)}"
        cases.append((random.randint(0, 100), "\n".join(own) + " " + " ".join(f"u{random.randint(0, 99)}" for _ in range(5))))
    cases += [(None, cases[0][1]), (5, None), (6, ""), (7, "a " * 100), (8, "a " * 50)]
    docs = spark.createDataFrame([(*c, 1) for c in cases], "doc_id long, text string, kept int")
    found = substrings.without_repeats(docs).select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert Counter(map(tuple, found.collect())) == Counter(brute.without_repeats(cases))
