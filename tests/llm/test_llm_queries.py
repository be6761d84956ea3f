"""The registered queries on the smallest given tables, against brute force."""

import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millpond.llm import bpe, licenses, quality_model
from millpond.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]


def run(spark, name):
    return QUERIES[name](spark, SF).toPandas()


def test_op1(spark, docs):
    found = run(spark, "op1_mix_sources").set_index("doc_id")
    sizes = defaultdict(int)
    for doc, text, source in docs:
        assert found.loc[doc]["size"] == len(brute.words(text))
        sizes[source] += len(brute.words(text))
    targets = brute.mix_targets(sizes)
    taken, most = defaultdict(int), defaultdict(int)
    for doc, text, source in docs:
        row = found.loc[doc]
        assert row.source_size == sizes[source] and row.target == pytest.approx(targets[source])
        assert row.taken <= 3 * row["size"] and row.taken == row.copies * row["size"]
        taken[source] += row.taken
        most[source] = max(most[source], row["size"])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * most[source]
    again = run(spark, "op1_mix_sources").set_index("doc_id")
    assert found.taken.sort_index().equals(again.taken.sort_index())


def test_op2(spark, docs):
    found = run(spark, "op2_byte_bpe").set_index("doc_id")
    encoding = bpe._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for doc, text, _ in docs:
        ids, row = encoding.encode_ordinary(text), found.loc[doc]
        assert row.n_tokens == len(ids) and row.decoded_sha256 == brute.sha(text)
        assert row.ids_sha256 == brute.sha(" ".join(map(str, ids)))


def test_op3(spark, docs):
    found = run(spark, "op3_license_scan").set_index("doc_id")
    lines = {name: text for name, text in licenses.TEMPLATES.items() if len(text) < 100}
    for doc, text, _ in docs:
        want = sorted((text.index(line), name) for name, line in lines.items() if line in text)
        got = sorted({s.split(":")[0] for s in found.loc[doc].spans.split(",") if s})
        assert got == sorted(name for _, name in want)


def test_op4(spark, docs):
    found = run(spark, "op4_quality_classifier").set_index("doc_id")
    assert len(found) == len(docs)
    for doc, row in found.iterrows():
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    scores = found.loc[labels.index].score
    pairs = scores[labels == 1].to_numpy()[:, None] - scores[labels == 0].to_numpy()[None, :]
    assert (pairs > 0).mean() > 0.95


def test_op5(spark, docs):
    found = run(spark, "op5_pii").set_index("doc_id")
    for doc, text, _ in docs:
        want, row = brute.base_spans(text), found.loc[doc]
        assert row.base_sha256 == brute.sha(want)
        assert [row[f"n_{k}"] for k in brute.PATTERNS] == [want.count(k) for k in brute.PATTERNS]
        own = [s for s in row.spans.split(",") if s and not s.startswith("term")]
        assert ",".join(own) == want


def test_op6(spark, docs):
    found = run(spark, "op6_token_counts").set_index("doc_id")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc, text, _ in docs:
        n, row = len(tokenizer.encode(text, add_special_tokens=False).ids), found.loc[doc]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 2048)


def test_op7(spark, docs):
    found = run(spark, "op7_simhash").set_index("doc_id")
    prints = [brute.fingerprint(text) for _, text, _ in docs]
    ids = [doc for doc, _, _ in docs]
    assert [found.loc[d].fingerprint for d in ids] == [f"{p:016x}" for p in prints]
    assert [found.loc[d].component_id for d in ids] == brute.components(prints, ids)


def test_op8(spark, docs):
    found = run(spark, "op8_quality_rules").set_index("doc_id")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for doc, text, _ in docs:
        want, row = brute.rule_stats(text), found.loc[doc]
        assert tuple(row[names]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert row.base_failed == failed and not (failed and row.kept)


def test_op9(spark):
    found = run(spark, "op9_inverted_multi_index")
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    hits = total = 0
    for query, own in found.sort_values("rank").groupby("query_id"):
        want = brute.nearest(vectors, query)
        hits += len({v for v, _ in want} & set(own.vec_id))
        total += len(want)
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        assert own.score.tolist() == sorted(own.score, reverse=True)
        for row in own.itertuples():
            a, b = np.array(vectors[query], float), np.array(vectors[row.vec_id], float)
            assert row.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    assert set(found.query_id) == {v for v in vectors if v % 50 == 0} and hits >= 0.9 * total


def test_op10(spark, docs):
    found = run(spark, "op10_substring_dedup")
    got = {tuple(r) for r in found[["doc_id", "n_words", "n_removed", "kept_sha256"]].itertuples(index=False)}
    assert got == set(brute.without_repeats([d[:2] for d in docs]))


def test_pipeline(spark):
    """Each stage against what it got: rejected, repeated and replaced rows are accounted for."""
    import corpus_pipeline as p

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, quality), (_, near), (_, pii), (_, mix), (_, tokens) = p.STAGES
    first = quality(spark, docs, SF)
    kept = {r.doc_id: r.text for r in first.collect()}
    scores = quality_model.scored(docs, spark.read.parquet(f"{SF}/labels.parquet")).select("doc.doc_id", "predicted")
    assert first.columns == columns and set(kept) == {r.doc_id for r in scores.collect() if r.predicted == 1}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.95 * len(good)

    second = near(spark, spark.createDataFrame(first.collect(), first.schema), SF)
    rows = second.collect()
    texts = [r.text for r in rows]
    assert second.columns == columns and len(set(texts)) == len(texts)  # no exact copy stays
    assert len(rows) >= 0.8 * len(set(kept.values()))

    third = pii(spark, spark.createDataFrame(rows, second.schema), SF)
    clean = third.collect()
    assert third.columns == columns and all(not brute.base_spans(r.text) for r in clean)
    untouched = {r.doc_id: r.text for r in rows if not brute.base_spans(r.text)}
    assert sum(untouched.get(r.doc_id, r.text) == r.text for r in clean) >= 0.98 * len(clean)

    fourth = mix(spark, spark.createDataFrame(clean, third.schema), SF)
    mixed = fourth.collect()
    assert fourth.columns == columns
    words = sum(len(brute.words(r.text)) for r in clean)
    assert abs(sum(len(brute.words(r.text)) for r in mixed) - words) < 0.2 * words
    last = tokens(spark, spark.createDataFrame(mixed, fourth.schema), SF).collect()
    encoding = bpe._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert sorted((r.doc_id, r.text) for r in last) == sorted((r.doc_id, r.text) for r in mixed)
    assert all(r.ids == encoding.encode_ordinary(r.text) for r in last)
