"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.llm import (
    ann,
    bpe,
    decontamination,
    licenses,
    mixing,
    pii,
    prefix_trie,
    quality_model,
    quality_rules,
    simhash,
    substrings,
    token_alignment,
    token_counts,
)
from millpond.llm.common import Work, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


ORACLES["op10_substring_dedup"] = r"""
    WITH split AS (
        SELECT doc_id, list_filter(string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
        FROM documents),
    windows AS (
        SELECT doc_id, start, array_to_string(words[start:start + 12], ' ') AS window_words
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS start FROM split WHERE len(words) >= 13)),
    firsts AS (SELECT window_words, MIN(doc_id) AS first_id FROM windows GROUP BY window_words),
    gone AS (
        SELECT doc_id, list(DISTINCT position) AS positions
        FROM (SELECT doc_id, unnest(range(start, start + 13)) AS position
              FROM windows JOIN firsts USING (window_words) WHERE first_id < doc_id)
        GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, COALESCE(len(positions), 0) AS n_removed,
           sha256(array_to_string(list_filter(words, lambda w, i: positions IS NULL OR NOT list_contains(positions, i)), ' '))
               AS kept_sha256
    FROM split LEFT JOIN gone USING (doc_id)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    """Copies of every document in a mix of the sources by weights 1, 2, 3."""
    docs = table(spark, sf_dir, "documents")
    # the texts stay behind once their words are counted
    sizes = docs.select("doc_id", "source", word_count("text").alias("words"))
    found = mixing.sampled(sizes, size=F.col("words"))
    return found.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


@query
def op2_byte_bpe(spark, sf_dir):
    """Ids of every whole text, and the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode(docs, path, public_tokenizers.PATTERN).select("doc.doc_id", "ids")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(bpe.decoded("ids", path), 256).alias("decoded_sha256"),
    )


@query
def op6_token_counts(spark, sf_dir):
    """Tokens of every whole text, and whether it exceeds a context of 2048."""
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    docs = table(spark, sf_dir, "documents").select("doc_id", n_bytes.alias("n_bytes"), "text")
    found = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc.doc_id", "doc.n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op7_simhash(spark, sf_dir):
    """64-bit fingerprints of 3-word shingles, and the documents connected within 2 bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, words=3, lanes=1, radius=2, agreement=None)
    return found.select("doc.doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


@query
def op10_substring_dedup(spark, sf_dir):
    """Words of every document left after removing 13-word passages of earlier documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.without_repeats(docs)
    return found.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_inverted_multi_index(spark, sf_dir):
    """The 5 nearest vectors of every fiftieth one."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op5_pii(spark, sf_dir):
    """Spans of personal data in every whole text, and of the terms that disclose it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.personal_data(docs).select("doc.doc_id", "spans")
    base = pii.KINDS[:4]

    def count_of(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count_of, base), F.sha2(pii.listed(F.col("spans"), base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


@query
def op8_quality_rules(spark, sf_dir):
    """Rule statistics of every whole text, and whether base rules and chosen cutoffs keep it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = quality_rules.judged(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op4_quality_classifier(spark, sf_dir):
    """Quality scores of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_model.scored(docs, table(spark, sf_dir, "labels"))
    return found.select("doc.doc_id", "held_out", "score", "predicted")


@query
def op3_license_scan(spark, sf_dir):
    """License notices in every whole text, and how much of each is there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scanned(docs)
    spans = F.transform("licenses", lambda m: F.concat_ws(":", m["name"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select(
        "doc.doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(spans, ",").alias("spans"),
        F.array_max(F.transform("licenses", lambda m: m["coverage"])).alias("coverage"),
    )


ORACLES["op11_decontamination"] = r"""
    WITH split AS (
        SELECT doc_id, row_number() OVER () AS row_no,
               regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents),
    item_split AS (
        SELECT COALESCE(item_id::VARCHAR, '') AS item,
               regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item, size, array_to_string(words[start:start + size - 1], ' ') AS passage
        FROM (SELECT item, words, LEAST(len(words), 10) AS size,
                     unnest(range(1, len(words) - LEAST(len(words), 10) + 2)) AS start
              FROM item_split WHERE len(words) > 0)),
    windows AS (
        SELECT row_no, size, start, array_to_string(words[start:start + size - 1], ' ') AS passage
        FROM (SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS start
              FROM split JOIN (SELECT DISTINCT size FROM item_windows) ON len(words) >= size)),
    hits AS (SELECT * FROM windows SEMI JOIN item_windows USING (passage, size)),
    positions AS (
        SELECT row_no, COUNT(DISTINCT position) AS n_hit
        FROM (SELECT row_no, unnest(range(start, start + size)) AS position FROM hits) GROUP BY row_no),
    items AS (
        SELECT row_no, list_sort(list(DISTINCT item)) AS items
        FROM (SELECT DISTINCT row_no, passage, size FROM hits) JOIN item_windows USING (passage, size) GROUP BY row_no)
    SELECT doc_id, len(words) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(len(items), 0) AS n_items,
           sha256(COALESCE(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM split LEFT JOIN positions USING (row_no) LEFT JOIN items USING (row_no)"""


@query
def op11_decontamination(spark, sf_dir):
    """Words of every whole text inside passages of the benchmark, and the items they come from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op12_token_alignment(spark, sf_dir):
    """Tokens of two tokenizers in every whole text, grouped where both end, and how their links stand in the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left, right = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = token_alignment.aligned(docs, left, right, written=lambda groups: F.when(groups != "", F.sha2(groups, 256)).otherwise(""))
    return found.select(
        "doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """Encoded conversations whose first turns, up to 8 by a checksum of the identifier, come from each fifth one."""
    first = own.select(F.col("conv").alias("base"), F.slice("ids", 1, 8).alias("base_ids"), F.slice("sizes", 1, 8).alias("base_sizes"))
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).cast("int")
    found = own.withColumn("taken", taken).join(first, F.col("conv") - F.col("conv") % 5 == F.col("base"), "left")

    def joined(base: str, column: str) -> F.Column:
        before = F.coalesce(F.slice(base, F.lit(1), F.col("taken")), F.expr("CAST(array() AS array<bigint>)"))
        return F.concat(before, F.slice(column, F.col("taken") + 1, F.size(column))).alias(column)

    return found.select("conv", joined("base_ids", "ids"), joined("base_sizes", "sizes"))


ORACLES["op13_prefix_trie"] = r"""
    WITH turns AS (
        SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    sums AS (
        SELECT conv_id, (xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bits),
            lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda s, unused: CASE WHEN (s & 1) = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END)))) % 9 AS taken
        FROM (SELECT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS bits
              FROM (SELECT DISTINCT conv_id FROM turns))),
    rebuilt AS (
        SELECT s.conv_id, t.place, t.role, t.text FROM sums s JOIN turns t ON t.conv_id = s.conv_id - s.conv_id % 5 AND t.place <= s.taken
        UNION ALL
        SELECT s.conv_id, t.place, t.role, t.text FROM sums s JOIN turns t ON t.conv_id = s.conv_id AND t.place > s.taken),
    placed AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, text,
               sha256(strlen(role)::VARCHAR || ':' || role || text) AS turn
        FROM rebuilt),
    paths AS (
        SELECT conv_id, depth, strlen(text) AS size, array_to_string(list(turn) OVER (PARTITION BY conv_id ORDER BY depth), '') AS node,
               COUNT(*) OVER (PARTITION BY conv_id) AS turns
        FROM placed
        UNION ALL
        SELECT conv_id, 0, 0, '', (SELECT COUNT(*) FROM placed p WHERE p.conv_id = s.conv_id) FROM sums s),
    grouped AS (
        SELECT node, ANY_VALUE(depth) AS depth, ANY_VALUE(size) AS size, COUNT(*) AS n_convs, MIN(conv_id) AS conv_id,
               sha256(COALESCE(string_agg(CASE WHEN turns = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
        FROM paths GROUP BY node),
    above AS (SELECT node, left(node, length(node) - 64) AS parent FROM grouped WHERE depth > 0),
    children AS (SELECT parent AS node, COUNT(*) AS n_children FROM above GROUP BY parent),
    flat AS (SELECT g.*, COALESCE(n_children, 0) AS n_children FROM grouped g LEFT JOIN children USING (node)),
    subtree AS (
        SELECT top AS node, SUM(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, SUM((n_convs - 1) * size) AS saved_tokens
        FROM (SELECT n_children, n_convs, size, left(node, 64 * unnest(range(0, depth + 1))::BIGINT) AS top FROM flat) GROUP BY top)
    SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
           n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
    FROM flat f JOIN subtree USING (node) LEFT JOIN above a ON a.node = f.node LEFT JOIN flat p ON p.node = a.parent"""


@query
def op13_prefix_trie(spark, sf_dir):
    """Every beginning of a rebuilt conversation: how many share it, and what sharing saves below it."""
    work = Work(spark)
    own, _ = prefix_trie.encoded(work, table(spark, sf_dir, "conversations"))
    found = prefix_trie.trie(work, work.staged(rebuilt(own), "rebuilt"))
    digests = prefix_trie.ends_digests(found.ends)
    return found.nodes.join(digests, F.col("id") == F.col("node"), "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
