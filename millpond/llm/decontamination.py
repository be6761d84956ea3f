"""Operator 11: passages of a benchmark in documents, by winnowing.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words,
but not none, is one window. A document word inside any occurrence of a window
is hit. Words are lower-cased (A-Z) runs of digits, letters and anything beyond
ASCII.

1. Winnowing: of the hashes of all groups of ``k`` words, the smallest one in
   each span of ``w`` groups is kept, with ``k + w - 1`` the length of a window.
   Both sides keep the same group of equal windows, so every shared window
   shares a fingerprint, whatever surrounds it. Items shorter than a window have
   lengths of their own (at most ``WINDOW`` of them), with a ``k`` and ``w`` each.
2. Fingerprints of the documents are joined to those of the items.
3. Each fingerprint met is extended to the windows that hold it, and these are
   joined to the windows of the items, word for word. A window stands once on
   the side of the items, so a document word meets at most one row for each
   window over it, however many items or documents share a passage.
4. Windows found are merged into spans. Items are named by lists: windows of
   the same items share a list, and documents with the same lists are resolved
   once, so that copies are not multiplied with the items they all hold.

Defined cases: NULL and empty texts have no words and no hits; items without
words have no windows; an item with a NULL identifier counts as the identifier
``''``; rows that repeat an item count as one item; repeated documents are each
judged; empty tables give no hits; further columns travel in ``doc``, which
holds all but the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millpond.llm.common import Work

#: Words of a window.
WINDOW = 10
#: Bytes hashed at a time; a longer text is cut between words.
BLOCK = 1 << 20

_ROW = pa.struct([("length", pa.int32()), ("start", pa.int32()), ("window", pa.string())])
_PRINTS = "struct<n_words:int,prints:array<struct<length:int,at:int,hash:long>>>"
_WINDOWS = "array<struct<length:int,start:int,window:string>>"

_codes = np.arange(256)
_LOWER = np.where((_codes >= 65) & (_codes <= 90), _codes + 32, _codes).astype(np.uint8)
_IN_WORD = ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x61) & (_codes <= 0x7A)) | (_codes >= 0x80)
#: Lower-cased bytes of words, and a space for every other byte.
_SPACED = bytes(np.where(_IN_WORD[_LOWER], _LOWER, 0x20).astype(np.uint8))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_OF_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8."""
    return (text or "").encode().translate(_SPACED).split()


def shape(length: int) -> tuple[int, int]:
    """Words of a group, and groups among which one is kept, for windows of a length."""
    k = (length + 1) // 2
    return k, length - k + 1


def _blocks(data: np.ndarray):
    """The bytes in blocks that end between words."""
    start = 0
    while start < len(data):
        end = start + BLOCK
        while end < len(data):
            gaps = np.flatnonzero(data[end : end + BLOCK] == 0x20)
            if len(gaps):
                end += int(gaps[0])
                break
            end += BLOCK
        yield data[start:end]
        start = end


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word of lower-cased bytes in which only spaces part words."""
    found = [np.empty(0, np.uint64)]
    for block in _blocks(np.frombuffer(data, np.uint8)):
        inside = block != 0x20
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
        lengths = edges[1::2] - edges[::2]
        if not len(lengths):
            continue
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
        found.append(_mix(np.add.reduceat(_OF_BYTE[block[inside]] * powers[place], first)))
    return np.concatenate(found)


def winnowed(hashes: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the groups kept for windows of a length, and their hashes.

    ``text`` numbers the text of each word; windows lie within one text. Of equal
    hashes in a span the last one is kept.
    """
    k, w = shape(length)
    if len(hashes) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    groups = np.full(len(hashes) - k + 1, length, np.uint64)
    for i in range(k):
        groups = _mix(groups * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(groups)] + np.uint64(i))
    starts = np.flatnonzero(text[length - 1 :] == text[: len(text) - length + 1])
    at, least = starts, groups[starts]
    for step in range(1, w):
        other = groups[starts + step]
        lower = other <= least
        at, least = np.where(lower, starts + step, at), np.where(lower, other, least)
    kept = np.unique(at)
    return kept, groups[kept]


def _printed(texts: list[str | None], lengths: list[int]) -> pa.Array:
    spaced = [(text or "").encode().translate(_SPACED) for text in texts]
    hashes = [word_hashes(data) for data in spaced]
    counts = np.array([len(h) for h in hashes], np.int64)
    every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    text = np.repeat(np.arange(len(texts)), counts)
    columns = []
    for length in lengths:
        at, value = winnowed(every, text, length)
        columns.append((text[at], np.full(len(at), length), at, value))
    if not columns:
        columns = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    of, length, at, value = (np.concatenate(c) for c in zip(*columns))
    order = np.argsort(of, kind="stable")
    of, length, at, value = of[order], length[order], at[order], value[order]
    at = at - (np.cumsum(counts) - counts)[of]
    rows = pa.StructArray.from_arrays(
        [pa.array(length.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(value.view(np.int64))],
        names=["length", "at", "hash"],
    )
    ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(texts))))).astype(np.int32)
    prints = pa.ListArray.from_arrays(pa.array(ends), rows)
    return pa.StructArray.from_arrays([pa.array(counts.astype(np.int32)), prints], names=["n_words", "prints"])


def _prints_of(lengths: list[int]):
    @arrow_udf(_PRINTS)
    def prints_of(texts: pa.Array) -> pa.Array:
        return _printed(texts.to_pylist(), lengths)

    return prints_of


def extended(text: str | None, hits: list[dict]) -> list[dict]:
    """The windows of a text around the groups met, each once."""
    own, found = words(text), set()
    for hit in hits:
        length, at = hit["length"], hit["at"]
        first = max(0, at - shape(length)[1] + 1)
        found.update((length, start) for start in range(first, min(at, len(own) - length) + 1))
    return [
        {"length": length, "start": start, "window": b" ".join(own[start : start + length]).decode()}
        for length, start in sorted(found)
    ]


def windows_of(text: str | None) -> list[dict]:
    """All windows of an item."""
    own = words(text)
    length = min(len(own), WINDOW)
    return [
        {"length": length, "start": start, "window": b" ".join(own[start : start + length]).decode()}
        for start in (range(len(own) - length + 1) if length else ())
    ]


def _windows_around(texts: pa.Array, hits: pa.Array) -> pa.Array:
    return pa.array(list(map(extended, texts.to_pylist(), hits.to_pylist())), pa.list_(_ROW))


def _windows_of_items(texts: pa.Array) -> pa.Array:
    return pa.array(list(map(windows_of, texts.to_pylist())), pa.list_(_ROW))


def _spans(windows) -> F.Column:
    """Windows (start, end), sorted, as spans without overlap."""
    none = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")

    def add(done, next_):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], next_["end"]).alias("end"))
        meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= next_["start"])
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(next_))
        )

    return F.aggregate(windows, none, add)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``doc`` (all columns but the text), ``n_words``, ``spans`` of words hit (end exclusive), ``n_hit`` and ``items``."""
    work = Work(docs.sparkSession)
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")
    )
    windows = work.staged(
        items.select("item", F.explode(arrow_udf(_windows_of_items, _WINDOWS)("text")).alias("w")).select("item", "w.window", "w.length"),
        "item-windows",
    )
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())  # at most WINDOW numbers
    own = F.when(F.col("p.n_words") < WINDOW, F.col("p.n_words")).otherwise(WINDOW)
    item_prints = work.staged(
        items.select(_prints_of(lengths)("text").alias("p"))
        .select(F.explode(F.filter("p.prints", lambda f: f["length"] == own)).alias("f"))
        .select(F.col("f.hash").alias("known"))
        .distinct(),
        "item-prints",
    )
    # windows of the same items share a list of them
    named = windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    named = work.staged(named.select("window", F.md5(F.to_json("items")).alias("list"), "items"), "item-lists")
    lists = named.groupBy("list").agg(F.first("items").alias("items"))

    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    found = docs.select(
        F.struct(*others).alias("doc"), F.col(text).alias("text"), _prints_of(lengths)(F.col(text)).alias("p")
    )
    found = work.staged(
        found.select("doc", "text", "p.n_words", "p.prints", F.monotonically_increasing_id().alias("key")), "doc-prints"
    )
    met = (
        found.select("key", F.explode("prints").alias("f"))
        .select("key", "f.length", "f.at", "f.hash")
        .join(item_prints, F.col("hash") == F.col("known"), "left_semi")
    )
    met = work.staged(met.groupBy("key").agg(F.collect_list(F.struct("length", "at")).alias("hits")), "prints-met")
    around = (
        found.select("key", "text")
        .join(met.withColumnRenamed("key", "of"), F.col("key") == F.col("of"), "inner")
        .select("key", F.explode(arrow_udf(_windows_around, _WINDOWS)("text", "hits")).alias("w"))
        .select("key", "w.window", F.struct(F.col("w.start").alias("start"), (F.col("w.start") + F.col("w.length")).alias("end")).alias("at"))
    )
    hit = (
        around.join(named.select(F.col("window").alias("shared"), "list"), F.col("window") == F.col("shared"), "inner")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("at")).alias("windows"), F.sort_array(F.collect_set("list")).alias("lists"))
        .select(F.col("key").alias("of"), _spans(F.col("windows")).alias("spans"), "lists", F.md5(F.to_json("lists")).alias("set"))
    )
    hit = work.staged(hit, "windows-hit")
    sets = hit.groupBy("set").agg(F.first("lists").alias("lists"))
    resolved = (
        sets.select("set", F.explode("lists").alias("one"))
        .join(lists, F.col("one") == F.col("list"), "inner")
        .select("set", F.explode("items").alias("item"))
        .groupBy("set")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumnRenamed("set", "of_set")
    )
    result = hit.select("of", "spans", "set").join(work.staged(resolved, "items-hit"), F.col("set") == F.col("of_set"), "inner")
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return (
        found.select("key", "doc", "n_words")
        .join(result.select("of", "spans", "items"), F.col("key") == F.col("of"), "left")
        .select(
            "doc",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:int,end:int>>)")).alias("spans"),
            F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        )
    )
