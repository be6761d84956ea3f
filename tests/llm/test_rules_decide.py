"""Rules at their production limits on a given table: cutoffs apply, few good documents go, and the choice is the stated one."""

from pyspark.sql import functions as F

import brute
from millpond.llm import quality_rules

SF = "/root/testdata/sf0.01"


def test_cutoffs_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    found = quality_rules.judged(docs, labels)
    names = quality_rules.rules()
    steps = [quality_rules.step_of(v).alias(n) for n, v in names.items()]
    rows = found.select("doc.doc_id", "doc.lang", "base_failed", "kept", *steps).collect()
    passed = [r for r in rows if not r.base_failed]
    cutoffs = brute.rule_cutoffs(
        [(r.lang, quality.get(r.doc_id), {n: r[n] for n in names}) for r in passed], quality_rules.FACTORS, 0.05, 0.05
    )
    assert cutoffs
    for r in rows:
        broken = any(r[rule] >= cut for rule, cut in cutoffs.get(r.lang, {}).items())
        assert r.kept == (not r.base_failed and not broken)
    good, bad = ([r for r in passed if quality.get(r.doc_id) == q] for q in (1, 0))
    lost, rejected = (sum(not r.kept for r in group) for group in (good, bad))
    print(f"good lost {lost} of {len(good)}, bad rejected {rejected} of {len(bad)}, cutoffs {cutoffs}")
    assert rejected > 0 and lost <= 0.05 * len(good)


def test_too_few_labels_reject_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    few = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id < 100")
    assert quality_rules.judged(docs, few).where(F.col("kept") == F.col("base_failed")).count() == 0
