"""Preparation of a training corpus: quality, near-duplicates, personal data, mix, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.llm import bpe, mixing, pii, quality_model, simhash
from millpond.llm.common import Work


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.scored(docs, labels).where("predicted = 1").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return simhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and the terms that disclose it replaced."""
    return pii.sanitised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources reach their target weights."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids; ``text`` is what the ids decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.encode(docs, path, public_tokenizers.PATTERN)
    text = bpe.decoded("ids", path).cast("string").alias("text")
    others = [F.col(f"doc.`{c}`") for c in docs.columns if c != "text"]
    return found.select(*others, text, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("personal data", personal_data),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokens),
]

#: The classifier, fingerprints and tokens cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over all documents; each is written and read again."""
    work = Work(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
