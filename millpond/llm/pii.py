"""Operator 5: personal data, and the terms that give it away.

DataFrame functions only. Emails, addresses, cards and phones are found by
fixed patterns; these spans are never dropped. Beyond them, terms are judged
by information theory over the whole corpus: of each protected entity (a found
value) the documents that hold it are counted, of each term those that hold
it, and of both those that hold both, anywhere. The surprise of the entity
given the term, -log2 p(entity | term), is what the term leaves undisclosed.
Where it leaves at most ``GENERALISED`` bits, the term is replaced by its kind
wherever it occurs; at most ``REMOVED`` bits, it is removed. A term must share
``SUPPORT`` documents with the entity in which the entity's surroundings differ,
so that copies of one text prove nothing, and tell at least ``TOLD`` bits.
Repeated rows count as one document in all three counts.

Defined cases: NULL counts as an empty text and stays NULL; matches that fail their
test are dropped without another try; a NULL identifier is an identifier of its
own; repeated rows are sanitised alike; an empty table gives an empty result;
further columns travel in ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millpond.llm.common import Work, packed

# The fixed patterns. Each may start only where the run of its first class does,
# or where the last match ended, and gives nothing back: the matches are those of
# the plain patterns, found in time linear in the text.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "term")
#: A term: letters, with marks, apostrophes and hyphens inside.
TERM = r"\p{L}[\p{L}\p{M}'’-]*+"

#: Characters to each side of an entity by which its surroundings are told apart.
CONTEXT = 120
SUPPORT, TOLD, GENERALISED, REMOVED = 2, 3.0, 1.0, 0.15

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.split(F.reverse(_digits(value)), "")

    def one(digit: Column, at: Column) -> Column:
        n = digit.cast("int")
        twice = F.when(n > 4, n * 2 - 9).otherwise(n * 2)
        return F.when(at % 2 == 1, twice).otherwise(n)

    return F.aggregate(F.transform(digits, one), F.lit(0), lambda total, n: total + n) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    n = F.length(_digits(value))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), _luhn(value)).otherwise(False))
        .otherwise(n.between(10, 15))
    )


def _matches(texts: DataFrame, patterns: dict[str, tuple[str, Column]], context: int = CONTEXT) -> DataFrame:
    """``id``, ``key``, ``kind``, ``start``, ``end``, ``value`` and ``context`` characters around of all matches.

    A pattern cuts the text into matches and what lies between them; positions
    are running sums of lengths, over the matches of one text.
    """
    cuts = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.when(possible, F.split("text", pattern, -1)).alias("between"),
                F.when(possible, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("values"),
            )
            for kind, (pattern, possible) in patterns.items()
        ]
    )
    cut = texts.select("id", "key", F.explode(cuts).alias("cut")).select("id", "key", "cut.*").where("size(values) > 0")
    one = F.transform(
        F.sequence(F.lit(1), F.size("values")),
        lambda i: F.struct(
            i.alias("no"),
            F.length(F.element_at("between", i)).alias("gap"),
            F.element_at("values", i).alias("value"),
            *([
                F.substring(F.element_at("between", i), -context, context).alias("before"),
                F.substring(F.element_at("between", i + 1), 1, context).alias("after"),
            ] if context else []),
        ),
    )
    rows = cut.select("id", "key", "kind", F.explode(one).alias("m")).select("id", "key", "kind", "m.*")
    rows = rows.dropDuplicates(["id", "key", "kind", "no"])  # rows that repeat a document
    so_far = Window.partitionBy("id", "key", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(so_far)
    return rows.withColumn("end", end).select(
        "id", "key", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", *(["before", "after"] if context else [])
    )


def base_spans(texts: DataFrame) -> DataFrame:
    """The valid matches of the fixed patterns, with the text around each."""
    digit, text = F.col("text").rlike("[0-9]"), F.col("text")
    patterns = {
        "email": (EMAIL, text.contains("@")),
        "ip": (IP, digit),
        "card": (CARD, digit),
        "phone": (PHONE, text.contains("+")),
    }
    return _matches(texts, patterns).where(_valid(F.col("kind"), F.col("value")))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def disclosing_terms(work: Work, texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``term`` and the bits it leaves, for the terms that disclose an entity.

    At most ``GENERALISED`` bits left means with_term <= 2 ** GENERALISED * with_entity,
    and ``TOLD`` bits told means that neither is in more than total / 2 ** TOLD
    documents: terms and entities that cannot pass are gone before they are paired.
    """
    document = ["id", "key"]
    counted = work.staged(texts.groupBy(*document).agg(F.count("*").alias("copies")), "documents")
    total, repeated = counted.agg(F.count("*"), F.max("copies")).first()
    most = (total or 0) / 2**TOLD

    entity = F.xxhash64("kind", "value")
    # one context per document: repeated lines do not count as more
    entities = spans.select(*document, entity.alias("entity"), F.xxhash64("before", "after").alias("context")).groupBy(
        *document, "entity"
    ).agg(F.min("context").alias("context"))
    known = (
        entities.groupBy(F.col("entity").alias("of_entity"))
        .agg(F.count("*").alias("with_entity"), F.countDistinct("context").alias("contexts"))
        .where((F.col("contexts") >= SUPPORT) & (F.col("with_entity") <= most))
        .drop("contexts")
    )
    entities = work.staged(entities.join(known, F.col("entity") == F.col("of_entity")).drop("of_entity"), "entity-documents")
    widest = entities.agg(F.max("with_entity")).first()[0] or 0

    each = F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")
    held = texts.select(F.lit(1).alias("weight"), each)
    if (repeated or 1) > 1:
        copies = counted.where("copies > 1").select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "copies")
        same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
        again = texts.join(copies, same).dropDuplicates(document).select((1 - F.col("copies")).cast("int").alias("weight"), each)
        held = held.unionByName(again)
    held = work.staged(
        held.groupBy(F.col("term").alias("of_term"))
        .agg(F.sum("weight").alias("with_term"))
        .where(F.col("with_term").between(SUPPORT, min(most, 2**GENERALISED * widest))),
        "term-documents",
    )
    holders = entities.select(F.col("id").alias("of_id"), F.col("key").alias("of_key")).distinct()
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    rare = (
        texts.join(holders, same, "left_semi")
        .select(*document, each)
        .join(held, F.col("term") == F.col("of_term"))
        .select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "term", "with_term")
        .distinct()
    )
    paired = entities.join(rare, same).where(F.col("with_term") <= 2**GENERALISED * F.col("with_entity"))
    pairs = paired.groupBy("term", "entity", "with_term", "with_entity").agg(
        F.countDistinct("context").alias("contexts"), F.count("*").alias("together")
    )
    told = F.log2(F.col("together") * F.lit(float(total or 0)) / (F.col("with_term") * F.col("with_entity")))
    left = F.log2(F.col("with_term") / F.col("together"))
    return (
        pairs.where((F.col("contexts") >= SUPPORT) & (told >= TOLD) & (left <= GENERALISED))
        .groupBy("term")
        .agg(F.min(left).alias("left"))
    )


def term_spans(work: Work, texts: DataFrame, terms: DataFrame) -> DataFrame:
    """All occurrences of the disclosing terms, as spans."""
    # written, so that the planner broadcasts few terms and shuffles by many
    terms = work.staged(terms, "disclosing-terms")
    holders = (
        texts.select("id", "key", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
        .join(terms.select(F.col("term").alias("of_term")), F.col("term") == F.col("of_term"), "left_semi")
        .select(F.col("id").alias("of_id"), F.col("key").alias("of_key"))
        .distinct()
    )
    holders = work.staged(holders, "term-holders")  # few of them are broadcast, and the texts stay where they are
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    found = _matches(texts.join(holders, same, "left_semi"), {"term": (TERM, F.lit(True))}, context=0)
    return found.join(terms.select(F.col("term").alias("of_term"), "left"), F.col("value") == F.col("of_term")).select(
        "id", "key", "kind", "start", "end", "value", "left"
    )


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (the input row), ``spans`` and ``sanitised`` (the text with all spans replaced) of every row.

    Spans hold kind, start, end (code points, end exclusive) and replacement, by
    start and then kind. Terms inside the base spans are not listed again.
    """
    work = Work(docs.sparkSession)
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = packed(docs.withColumn("_plain", plain), id=doc_id, text="_plain").withColumns(
        {"doc": F.col("doc").dropFields("_plain"), "key": F.xxhash64("text")}
    )
    texts = rows.select("id", "key", "text")
    base = work.staged(base_spans(texts), "base-spans")
    terms = term_spans(work, texts, disclosing_terms(work, texts, base))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    label = F.concat(F.lit("["), F.upper("kind"), F.lit("]"))
    general = F.when(F.col("value").rlike(r"^\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("[TERM]"))
    replacement = F.when(F.col("kind") != "term", label).when(F.col("left") <= REMOVED, F.lit("")).otherwise(general)
    each = base.withColumn("left", F.lit(None).cast("double")).select(*terms.columns).unionByName(terms)
    span = F.struct("start", order.alias("order"), "kind", "end", replacement.alias("replacement"))
    spans = work.staged(
        each.groupBy(F.col("id").alias("of_id"), F.col("key").alias("of_key")).agg(F.sort_array(F.collect_list(span)).alias("spans")),
        "spans",
    )
    kept = F.filter(
        "spans",
        lambda s: (s["kind"] != "term")
        | ~F.exists("spans", lambda b: (b["kind"] != "term") & (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    found = rows.join(spans.withColumn("spans", kept), same, "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType))
    )
    # from left to right: what lies before the span, then its replacement; an overlapping span adds nothing but its end
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate(
        "spans",
        start,
        lambda state, s: F.struct(
            F.when(
                s["start"] >= state["at"],
                F.concat(state["out"], F.expr("text").substr(state["at"].cast("int") + 1, (s["start"] - state["at"]).cast("int")), s["replacement"]),
            ).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        ),
    )
    whole = F.concat(done["out"], F.col("text").substr(done["at"].cast("int") + 1, F.length("text")))
    sanitised = F.when(F.size("spans") == 0, F.col(f"doc.`{text}`")).otherwise(whole)
    return found.select("doc", "spans", sanitised.alias("sanitised"))


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of some kinds, joined by commas."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the sanitised texts, and their lengths in ``length`` where it exists."""
    found = personal_data(docs, doc_id, text)
    columns = []
    for c in docs.columns:
        value = F.col(f"doc.`{c}`")
        if c == text:
            value = F.col("sanitised")
        elif c == length:
            value = F.when(F.size("spans") > 0, F.length("sanitised").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return found.select(*columns)
