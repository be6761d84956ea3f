"""Operator 10: removing repeated passages with sharded phrase automata.

A window is ``WINDOW`` consecutive words. A word is removed if a window over
it also starts in a document with a smaller identifier.

1. Every window has an anchor, the group of ``GRAM`` words with the smallest
   hash in it, so equal windows have equal anchors. Only about a fifth of the
   positions are anchors; those found in two documents are recurring.
2. Documents give their pieces: the words of the neighbouring windows that
   share one recurring anchor. All pieces of an anchor belong to one shard, so
   the shard can confirm which windows recur, and where first.
3. Each shard compiles the confirmed phrases, runs of recurring windows with
   one first document, into an Aho-Corasick automaton over word numbers, and
   streams its pieces of all documents through it. Where an anchor comes again
   within a piece, as in a repeated line, each different window is a phrase, so
   that repetitions of many lengths do not match inside each other.

Anchors that very many documents have go to shards of their own: there the
windows are confirmed by an aggregation first, and the stream is cut into parts
which each get the confirmed phrases. Matches compare words, not hashes.

Defined cases: NULL and empty texts have no words; a document with a NULL
identifier keeps all words and takes none from others; rows that repeat an
identifier do not repeat each other; an empty table gives an empty result;
further columns travel in ``doc``, which holds all but the text.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millpond.llm.common import Work, byte_words

#: Words of a window, and of the groups among which its anchor is chosen.
WINDOW, GRAM = 13, 5
#: An anchor in more documents than this is confirmed by aggregation.
CROWD = 2000
#: Pieces of a shard, and of a part of its stream. An automaton's root has an
#: edge for each first word, which are searched one by one: small shards are fast.
SHARD, PART = 5_000, 40_000
#: Words of a piece around one anchor; in a longer one the anchor comes again.
LONGEST = 2 * WINDOW - GRAM


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _words(texts: list[str]) -> list[list[bytes]]:
    return [[word for some in byte_words(text.encode()) for word in some] for text in texts]


def anchors(texts: list[list[bytes]], known: _WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, in all texts: start of the first window, end of the last, the anchor.

    Positions count the words of all texts, one text after the other.
    """
    counts = np.array([len(words) for words in texts], np.int64)
    total = int(counts.sum())
    if total < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = np.concatenate([np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) for words in texts])
    grams = np.zeros(total - GRAM + 1, np.uint64)
    for i in range(GRAM):
        grams = _mix(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(grams)] + np.uint64(i))
    least, reach = grams, 1
    while reach < WINDOW - GRAM + 1:  # minima over doubling spans
        step = min(reach, WINDOW - GRAM + 1 - reach)
        least, reach = np.minimum(least[:-step], least[step:]), reach + step
    text = np.repeat(np.arange(len(texts)), counts)
    starts = np.flatnonzero(text[WINDOW - 1 :] == text[: 1 - WINDOW])
    values = least[starts]
    heads = np.ones(len(starts), bool)
    heads[1:] = (values[1:] != values[:-1]) | (np.diff(starts) != 1)
    first = np.flatnonzero(heads)
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    return starts[first], starts[last] + WINDOW, values[first].view(np.int64)


def automaton(phrases: pd.DataFrame) -> tuple[ahocorasick.Automaton, dict[str, int]]:
    """The confirmed phrases of rows (anchor, text, first, last), and the numbers of the words.

    A window recurs if the first document that has it is not the last. Equal
    windows have equal anchors, so the pieces of one anchor decide it. Each
    phrase is kept with its length and first document.
    """
    numbers: dict[str, int] = {}
    single: set[tuple[int, ...]] = set()
    found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    by_anchor: dict[int, list[tuple[tuple[int, ...], int, int]]] = {}
    for anchor, text, first, last in zip(*(phrases[f"p_{c}"].tolist() for c in ("anchor", "text", "first", "last"))):
        letters = tuple([numbers.setdefault(word, len(numbers) + 1) for word in text.split(" ")])
        by_anchor.setdefault(anchor, []).append((letters, first, last))
    for pieces in by_anchor.values():
        if len(pieces) == 1:  # no other piece shares its windows
            letters, first, last = pieces[0]
            if first < last:
                found.add_word(letters, (len(letters), first))
            continue
        windows: dict[tuple[int, ...], tuple[int, int]] = {}
        for letters, first, last in pieces:
            for i in range(len(letters) - WINDOW + 1):
                key = letters[i : i + WINDOW]
                low, high = windows.get(key, (first, last))
                windows[key] = (min(low, first), max(high, last))
        for letters, _, _ in pieces:
            if len(letters) > LONGEST:
                keys = {letters[i : i + WINDOW] for i in range(len(letters) - WINDOW + 1)} - single
                single |= keys
                for key in keys:
                    if windows[key][0] < windows[key][1]:
                        found.add_word(key, (WINDOW, windows[key][0]))
                continue
            begin, own = 0, None
            for i in range(len(letters) - WINDOW + 2):
                low, high = windows[letters[i : i + WINDOW]] if i + WINDOW <= len(letters) else (0, 0)
                now = low if low < high else None
                if now != own or i + WINDOW > len(letters):
                    if own is not None:
                        run = letters[begin : i - 1 + WINDOW]
                        found.add_word(run, (len(run), own))
                    begin, own = i, now
    if len(found):
        found.make_automaton()
    return found, numbers


def _located(phrases: pd.DataFrame, stream: pd.DataFrame) -> pd.DataFrame:
    """Word ranges, per document, whose windows start in an earlier document."""
    out = pd.DataFrame({c: np.empty(0, np.int64) for c in ("id", "key", "low", "high")})
    if not len(phrases) or not len(stream):
        return out
    found, numbers = automaton(phrases)
    if not len(found):
        return out
    number = numbers.get
    codes, texts = pd.factorize(stream["text"])
    ids, keys, begins = (stream[c].to_numpy() for c in ("id", "key", "begin"))
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(texts)))
    rows, lows, highs = [], [], []
    for code, text in enumerate(texts):  # equal pieces give equal matches
        matches = [(end + 1 - length, end + 1, first) for end, (length, first) in found.iter(tuple([number(w, 0) for w in text.split(" ")]))]
        if not matches:
            continue
        own = order[ends[code - 1] if code else 0 : ends[code]]
        # documents after the same firsts have the same ranges
        firsts = np.unique([first for _, _, first in matches])
        levels = np.searchsorted(firsts, ids[own])
        for level in np.unique(levels[levels > 0]):
            merged = _merged((low, high) for low, high, first in matches if first <= firsts[level - 1])
            later = own[levels == level]
            rows.append(np.repeat(later, len(merged)))
            lows += [low for low, _ in merged] * len(later)
            highs += [high for _, high in merged] * len(later)
    if not rows:
        return out
    row = np.concatenate(rows)
    return pd.DataFrame(
        {"id": ids[row], "key": keys[row], "low": begins[row] + np.array(lows, np.int64), "high": begins[row] + np.array(highs, np.int64)}
    )


def _merged(ranges) -> list[tuple[int, int]]:
    """Ranges, in any order, without overlap."""
    merged: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def _located_across(phrases: pd.DataFrame, stream: pd.DataFrame) -> pd.DataFrame:
    """The same for a part of a crowded shard, joined to one row per document before it is shuffled."""
    found = _located(phrases, stream).sort_values(["id", "key", "low"], ignore_index=True)
    if not len(found):
        return pd.DataFrame({"id": found["id"], "key": found["key"], "lows": [], "highs": []})
    document = found.groupby(["id", "key"], sort=False).ngroup().to_numpy()
    low, high = found["low"].to_numpy(), found["high"].to_numpy()
    # documents far apart on one line: a range starts anew where it lies beyond all before it
    apart = document * (int(high.max()) + 2)
    reach = np.maximum.accumulate(high + apart)
    heads = np.flatnonzero(np.append(True, (low + apart)[1:] > reach[:-1]))
    ends = reach[np.append(heads[1:], len(low)) - 1] - apart[heads]
    rows = np.flatnonzero(np.append(True, np.diff(document[heads]) != 0))
    return pd.DataFrame(
        {
            "id": found["id"].to_numpy()[heads[rows]],
            "key": found["key"].to_numpy()[heads[rows]],
            "lows": np.split(low[heads], rows[1:]),
            "highs": np.split(ends, rows[1:]),
        }
    )


def _located_within(stream: pd.DataFrame) -> pd.DataFrame:
    """The same for a shard that holds all pieces of its anchors: they are the phrases to confirm."""
    codes, texts = pd.factorize(stream["text"])
    ids, some = stream["id"].to_numpy(), np.zeros(len(texts), np.int64)
    first, last = np.full(len(texts), np.iinfo(np.int64).max), np.full(len(texts), np.iinfo(np.int64).min)
    np.minimum.at(first, codes, ids)
    np.maximum.at(last, codes, ids)
    some[codes] = np.arange(len(codes))
    anchor = stream["anchor"].to_numpy()[some]
    return _located(pd.DataFrame({"p_anchor": anchor, "p_text": texts, "p_first": first, "p_last": last}), stream)


def _kept(words: list[bytes], lows: list[int], highs: list[int]) -> tuple[int, int, bytes]:
    kept, at = [], 0
    for low, high in sorted(zip(lows, highs)):
        if low > at:
            kept += words[at:low]
        at = max(at, high)
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def repeated_ranges(work: Work, docs: DataFrame) -> DataFrame:
    """``id``, ``key`` and the ranges (``lows``, ``highs``) of words to remove, from ``id``, ``key`` (of the text) and ``text``."""
    known = _WordHashes()

    @arrow_udf("array<long>")
    def anchors_of(texts: pa.Array) -> pa.Array:
        words = _words(texts.to_pylist())
        begins, _, values = anchors(words, known)
        offsets = np.searchsorted(begins, np.cumsum([0, *map(len, words)]))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

    def pieces_of(batches):
        for batch in batches:
            words = _words(batch["text"].to_pylist())
            starts = np.cumsum([0, *map(len, words)])
            begins, ends, values = anchors(words, known)
            text = np.searchsorted(starts, begins, side="right") - 1
            # an anchor is looked up among the recurring ones of its own text
            lists = batch["recurring"]
            own = np.repeat(np.arange(len(words)), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            recurring, crowded = flat.field(0).to_numpy(), flat.field(1).to_numpy(zero_copy_only=False)
            turn = np.int64(0x1E3779B97F4A7C15)
            keys = recurring + own * turn
            order = np.argsort(keys)
            at = np.searchsorted(keys[order], values + text * turn)
            at = order[np.minimum(at, len(order) - 1)] if len(order) else np.zeros(len(values), np.int64)
            hit = np.flatnonzero((recurring[at] == values) & (own[at] == text)) if len(order) else np.empty(0, np.int64)
            text, low, high = text[hit], begins[hit] - starts[text[hit]], ends[hit] - starts[text[hit]]
            joined = [b" ".join(words[t][a:b]) for t, a, b in zip(text.tolist(), low.tolist(), high.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(text)), batch["key"].take(pa.array(text)), pa.array(values[hit]),
                    pa.array(crowded[at[hit]], pa.bool_()), pa.array(low), pa.array(joined, pa.binary()).cast(pa.string()),
                ],
                ["id", "key", "anchor", "crowded", "begin", "text"],
            )

    marks = work.staged(docs.select("id", "key", F.explode(anchors_of("text")).alias("anchor")), "anchors")
    recurring = (
        marks.groupBy("anchor")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
        .where("first < last")
        .select(F.col("anchor").alias("of"), (F.col("n") > CROWD).alias("crowded"))
    )
    candidates = work.staged(
        marks.join(recurring.hint("shuffle_hash"), F.col("anchor") == F.col("of"), "inner")
        .groupBy(F.col("id").alias("of_id"), F.col("key").alias("of_key"))
        .agg(F.collect_list(F.struct("anchor", "crowded")).alias("recurring")),
        "recurring-anchors",
    )
    work.drop(marks)
    own = (F.col("id") == F.col("of_id")) & (F.col("key") == F.col("of_key"))
    pieces_table = work.staged(
        docs.join(candidates.hint("shuffle_hash"), own, "inner").select("id", "key", "text", "recurring").mapInArrow(
            pieces_of, "id long, key long, anchor long, crowded boolean, begin long, text string"
        ),
        "pieces",
    )
    work.drop(candidates)
    counts = pieces_table.agg(F.count("*"), F.count_if("crowded")).first()
    plain, crowded = pieces_table.where("NOT crowded"), pieces_table.where("crowded")
    ranges = "id long, key long, low long, high long"
    shard = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-counts[0] // SHARD))))
    within = plain.groupBy(shard.alias("shard")).applyInPandas(_located_within, ranges)

    crowded = crowded.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-counts[1] // SHARD)))))
    parts = work.staged(
        crowded.groupBy(F.col("shard").alias("of_shard")).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "parts"
    )
    span = [F.min("first").alias("first"), F.max("last").alias("last")]
    windows = F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.array_join(F.slice("words", i, WINDOW), " ")
    )
    confirmed = (
        crowded.groupBy("shard", "anchor", "text")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .withColumn("words", F.split("text", " "))
        .select("shard", "anchor", "first", "last", F.explode(windows).alias("text"))
        .groupBy("shard", "anchor", "text")
        .agg(*span)
        .where("first < last")
    )
    in_shard = F.col("shard") == F.col("of_shard")
    phrases = (
        confirmed.join(parts, in_shard)
        .select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "anchor", "text", "first", "last")
        .select(*[F.col(c).alias(f"p_{c}") for c in ("shard", "part", "anchor", "text", "first", "last")])
    )
    stream = crowded.join(parts, in_shard).select(
        "shard", F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int").alias("part"), "id", "key", "begin", "text"
    )
    across = (
        phrases.groupBy("p_shard", "p_part")
        .cogroup(stream.groupBy("shard", "part"))
        .applyInPandas(_located_across, "id long, key long, lows array<long>, highs array<long>")
    )
    # single ranges are gathered per document before they meet the lists: arrays of one would be large rows
    gathered = within.groupBy("id", "key").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    spans = gathered.unionByName(across).groupBy("id", "key").agg(
        F.flatten(F.collect_list("lows")).alias("lows"), F.flatten(F.collect_list("highs")).alias("highs")
    )
    spans = work.staged(spans, "removed-words")
    work.drop(pieces_table)
    return spans


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (all columns but the text), ``n_words``, ``n_removed`` and ``kept`` (the words left) of every row."""

    @arrow_udf("struct<n_words:long,n_removed:long,kept:string>")
    def kept_of(texts: pa.Array, lows: pa.Array, highs: pa.Array) -> pa.Array:
        rows = [
            _kept(words, low or (), high or ())
            for words, low, high in zip(_words(texts.to_pylist()), lows.to_pylist(), highs.to_pylist())
        ]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.StructArray.from_arrays([*arrays[:2], arrays[2].cast(pa.string())], ["n_words", "n_removed", "kept"])

    work = Work(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*others).alias("doc"), F.col(doc_id).cast("long").alias("id"), F.xxhash64(plain).alias("key"), plain.alias("text"))
    spans = repeated_ranges(work, rows.where("id IS NOT NULL").select("id", "key", "text"))
    spans = spans.withColumnsRenamed({"id": "of_id", "key": "of_key"})
    own = (F.col("id") == F.col("of_id")) & (F.col("key") == F.col("of_key"))
    return rows.join(spans.hint("shuffle_hash"), own, "left").select("doc", kept_of("text", "lows", "highs").alias("found")).select("doc", "found.*")
