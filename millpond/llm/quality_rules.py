"""Operator 8: quality rules with risk-controlled thresholds.

Each rule is a share that is high in bad texts. Per stratum (language) the
cutoffs of all rules form one family of levels, each stricter than the one
before: at a level, a rule's cutoff is the lowest step above which the share of
documents labelled bad is at least a factor higher than that of unlabelled
documents, and the factor falls from level to level. So the family depends on
no good label. On the documents labelled good the levels are tested in their
order: a level is admissible while the exact binomial test rejects that all
rules together drop more than ``alpha`` of the good documents, at ``delta``
divided by the number of strata (Bonferroni). Within a stratum a fixed sequence
needs no correction, so with probability 1 - ``delta`` no stratum loses more
than ``alpha`` of its good documents. Among admissible levels the one that best
separates bad from good is taken, the loosest of equals, and none if it drops
no more bad than good documents. Strata with too few labels (85 good ones at
four strata, without a loss) get no cutoff, and their documents are kept.

Defined cases: a NULL or empty text has no words and fails the base rules; a
NULL stratum is a stratum of its own; NULL labels count as missing, and of
several labels of a document the worst counts; an empty table gives an empty
result; further columns travel in ``doc``, which holds all but the text.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millpond.llm.common import Work, byte_words

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
#: Cutoffs are tried in steps of a hundredth.
STEPS = 100
#: By how much more of the bad than of the unlabelled documents a rule drops, level by level.
FACTORS = (64, 32, 16, 12, 8, 6, 4, 3, 2, 1.5)

_STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_capitals", "n_marks")


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * distinct + ids[1:]
    if distinct >= 1 << 20:  # three numbers would not fit in one
        pair = np.unique(pair, return_inverse=True)[1]
    windows = pair[:-1] * distinct + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= twice
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts named in ``_STATS``."""
    text = text or ""
    data = text.encode()
    numbers: dict[bytes, int] = {}
    parts = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in some), np.int64, len(some)) for some in byte_words(data)]
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(ids),
        len(text) - sum(map(text.count, _SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(ids, len(numbers)),
        len(numbers),
        len(data) - len(data.translate(None, bytes(range(65, 91)))),
        sum(map(text.count, "!?")),
    )


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def rules() -> dict[str, Column]:
    """Each rule as a share over the statistics of a text; high is bad."""
    length = _share("word_chars", "n_words")
    return {
        "symbols": _share("n_symbols", "n_words"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
        "few_words": 1 - _share("n_distinct", "n_words"),
        "capitals": _share("n_capitals", "word_chars"),
        "marks": _share("n_marks", "n_words"),
        "long_words": length / 50,
        "short_words": F.when(F.col("n_words") > 0, F.greatest(F.lit(0.0), 1 - length / 10)).otherwise(0.0),
    }


def most_losses(n: int, share: float, level: float) -> int:
    """The largest k with P(Binomial(n, share) <= k) <= level, or -1."""
    total, k = 0.0, -1
    while k + 1 <= n:
        log = (
            math.lgamma(n + 1) - math.lgamma(k + 2) - math.lgamma(n - k)
            + (k + 1) * math.log(share) + (n - k - 1) * math.log1p(-share)
        )
        total += math.exp(log)
        if total > level:
            break
        k += 1
    return k


def cutoff(steps: np.ndarray, good: np.ndarray, bad: np.ndarray, share: float, level: float) -> int | None:
    """The step from which a rule rejects, from counts of good and bad documents per step."""
    order = np.argsort(-steps)
    steps, lost, caught = steps[order], np.cumsum(good[order]), np.cumsum(bad[order])
    if not lost[-1] or not caught[-1]:
        return None
    admissible = lost <= most_losses(int(lost[-1]), share, level)
    gain = np.where(admissible, caught / caught[-1] - lost / lost[-1], -1.0)
    best = int(gain.argmax())  # the first of equals is the loosest
    return int(steps[best]) if gain[best] > 0 else None


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc`` (all columns but the text) and the statistics of every row."""

    @arrow_udf("struct<" + ",".join(f"{name}:long" for name in _STATS) + ">")
    def stats_of(texts: pa.Array) -> pa.Array:
        rows = np.array([text_stats(t) for t in texts.to_pylist()], np.int64).reshape(-1, len(_STATS))
        return pa.StructArray.from_arrays([pa.array(column) for column in rows.T], names=list(_STATS))

    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    found = docs.select(F.struct(*others).alias("doc"), stats_of(F.col(text)).alias("s")).select("doc", "s.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def family(bad: np.ndarray, others: np.ndarray, n_bad: int, n_others: int) -> list[int]:
    """A rule's cutoff at each level, from counts of bad and of unlabelled documents per step; ``STEPS`` + 1 drops none."""
    tail_bad = np.cumsum(bad[::-1])[::-1] / max(n_bad, 1)
    tail_others = np.maximum(np.cumsum(others[::-1])[::-1] / max(n_others, 1), 1 / (n_others + 1))
    factor = tail_bad / tail_others
    return [int(np.flatnonzero(factor >= f)[0]) if (factor >= f).any() else STEPS + 1 for f in FACTORS]


def thresholds(known: DataFrame, alpha: float, delta: float) -> DataFrame:
    """``stratum`` and the map ``cutoffs`` of its rules, from ``stratum``, ``label`` (NULL if unlabelled) and the statistics."""
    names = rules()
    steps = [F.struct(F.lit(n).alias("rule"), step_of(v).alias("step")) for n, v in names.items()]
    counts = (
        known.where("label IS NULL OR label != 1")
        .select("stratum", F.col("label").isNotNull().alias("bad"), F.explode(F.array(*steps)).alias("r"))
        .groupBy("stratum", "r.rule", "r.step")
        .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("others"))
    )

    def families(group: pd.DataFrame) -> pd.DataFrame:
        # at most a row for each rule and step; each document is in one step of each rule
        sizes = group.groupby("rule")[["bad", "others"]].sum().max()
        rows = []
        for rule, own in group.groupby("rule"):
            at = {c: np.bincount(own["step"], own[c], STEPS + 1) for c in ("bad", "others")}
            if sizes["bad"]:
                rows.append((group["stratum"].iloc[0], rule, family(at["bad"], at["others"], sizes["bad"], sizes["others"])))
        return pd.DataFrame(rows, columns=["stratum", "rule", "levels"])

    built = counts.groupBy("stratum").applyInPandas(families, "stratum string, rule string, levels array<int>")
    built = built.groupBy(F.col("stratum").alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "levels"))).alias("levels"))
    labelled = known.where("label IS NOT NULL")
    strata = labelled.select("stratum").distinct().count()

    def passed(rule: str, step: Column) -> Column:
        return F.size(F.filter(F.col("levels")[rule], lambda cut: cut > step))

    # the first level at which any rule drops the document
    dropped = F.least(*[passed(n, step_of(v)) for n, v in names.items()])
    tested = (
        labelled.join(built, F.col("stratum").eqNullSafe(F.col("of")), "inner")
        .groupBy("stratum", dropped.alias("level"))
        .agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") != 1).alias("bad"))
    )
    test_level = delta / max(1, strata)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        # the loosest level has the highest number for ``cutoff``; the last one, of documents never dropped, gains nothing
        step = cutoff(-group["level"].to_numpy(), group["good"].to_numpy(), group["bad"].to_numpy(), alpha, test_level)
        chosen = group.iloc[: 0 if step is None else 1]
        return pd.DataFrame({"stratum": chosen["stratum"], "level": [-(step or 0)] * len(chosen)})

    found = tested.groupBy("stratum").applyInPandas(choose, "stratum string, level int")
    cutoffs = F.transform_values("levels", lambda _, levels: levels[F.col("level")])
    return found.join(built, F.col("stratum").eqNullSafe(F.col("of")), "inner").select("stratum", cutoffs.alias("cutoffs"))


def step_of(share: Column) -> Column:
    return F.least(F.floor(share * STEPS), F.lit(STEPS)).cast("int")


def judged(
    docs: DataFrame,
    labels: DataFrame,
    alpha: float = 0.05,
    delta: float = 0.05,
    doc_id: str = "doc_id",
    stratum: str = "lang",
    quality: str = "quality",
    text: str = "text",
) -> DataFrame:
    """``doc`` (all columns but the text), the statistics, ``base_failed`` and ``kept`` of every row."""
    work = Work(docs.sparkSession)
    found = work.staged(
        statistics(docs, text).withColumns({"id": F.col(f"doc.`{doc_id}`"), "stratum": F.col(f"doc.`{stratum}`").cast("string")}),
        "text-statistics",
    )
    known = labels.groupBy(F.col(doc_id).alias("of_id")).agg(F.min(quality).alias("label")).where("label IS NOT NULL")
    labelled = found.where("NOT base_failed").join(known, F.col("id") == F.col("of_id"), "left")
    chosen = work.staged(thresholds(labelled, alpha, delta).withColumnRenamed("stratum", "of"), "cutoffs")
    broken = [F.coalesce(step_of(value) >= F.col("cutoffs")[name], F.lit(False)) for name, value in rules().items()]
    rejected = broken[0]
    for one in broken[1:]:
        rejected |= one
    return found.join(chosen, F.col("stratum").eqNullSafe(F.col("of")), "left").select(
        "doc", *_STATS, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept")
    )
