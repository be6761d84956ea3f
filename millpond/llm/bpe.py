"""Operator 2: byte-level BPE encoding and decoding, long texts by overlapping chunks.

A text of up to ``CHUNK`` code points is encoded as it is. A longer one is cut
into chunks that overlap by ``OVERLAP``; the chunks are pre-tokenised in
parallel, each from its own first character, and stitched: the first pre-token
boundary in an overlap that both neighbours found ends the one piece and
starts the next, since the splitting pattern looks at nothing before a
boundary. The pieces are encoded in parallel and their ids put together in
order. Where neighbours share no boundary in the overlap (a pre-token longer
than it, or characters that Unicode has not assigned, on whose class two
libraries may differ), the chunks from there on form one piece. Equal long
texts are encoded once. Decoding concatenates the raw bytes of the ids.

Defined cases: a NULL text counts as empty, an empty text has no ids, special
strings are ordinary text, repeated rows are all kept, an empty table gives an
empty result, further columns travel in ``doc``.
"""

from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millpond.llm.common import Work, packed

#: Code points of a chunk, and by how many the next one starts earlier.
CHUNK, OVERLAP = 1 << 15, 1 << 10


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def _token_bytes(path: str) -> pa.Array:
    ranks = _ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.binary())


def _id_lists(texts, path: str, pattern: str) -> pa.Array:
    encode = _encoding(path, pattern).encode_ordinary
    found = [np.array(encode(text or ""), dtype=np.int32) for text in texts]
    ends = np.cumsum([0, *map(len, found)])
    values = np.concatenate(found) if found else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _joined_bytes(lists: pa.Array, path: str) -> pa.Array:
    """The bytes of each list of ids, one token behind the other; none for NULL."""
    ids = lists.flatten()
    if not len(ids):
        return pa.array([b""] * len(lists), pa.binary())
    tokens = _token_bytes(path).take(ids)
    # the tokens lie one behind the other already: a list is what lies between its first and its last
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    starts = np.frombuffer(tokens.buffers()[1], np.int32)[np.concatenate([[0], np.cumsum(lengths)])]
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(starts), tokens.buffers()[2]])


def chunks_of(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """(number, text) of the overlapping chunks: each has ``chunk`` characters and those of the overlap."""
    return [
        (no, text[start : start + chunk + overlap])
        for no, start in enumerate(range(0, max(1, len(text)), chunk))
    ]


def boundaries(text: str, start: int, chunk: int, overlap: int, pattern: str) -> tuple[list[int], list[int]]:
    """Pre-token boundaries of a chunk at ``start`` of its text that lie in its first and its last overlap.

    None are reported for an overlap with unassigned characters. The last
    pre-tokens of a cut chunk may go on behind it: only boundaries that have
    a whole pre-token and its next character after them count.
    """
    found = [match.start() for match in regex.finditer(pattern, text)]
    if len(text) > chunk:  # cut: what touches the end is not known to end there
        found = found[:-2]

    def zone(low: int, high: int) -> list[int]:
        if any(unicodedata.category(c) == "Cn" for c in text[max(0, low - 1) : high + 1]):
            return []
        return [start + at for at in found if low <= at < high]

    return zone(0, overlap) if start else [0], zone(chunk, chunk + overlap)


def stitched(heads: list[list[int]], tails: list[list[int]]) -> list[tuple[int, int]]:
    """For each chunk (piece, first own position), given its boundaries in both overlaps.

    A piece has several chunks where neighbours do not resynchronise; from
    there on the boundaries are unproven, so the rest is one piece.
    """
    out, piece, proven = [(0, 0)], 0, True
    for no in range(1, len(heads)):
        common = sorted(set(tails[no - 1]) & set(heads[no])) if proven else []
        proven = bool(common)
        if proven:
            piece += 1
        out.append((piece, common[0] if proven else -1))
    return out


def _long_ids(work: Work, texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``key`` and ``ids`` of each different long text."""

    def cut(batches):
        for batch in batches:
            for key, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist()):
                parts = chunks_of(text, chunk, overlap)
                yield pa.RecordBatch.from_pydict(
                    {"key": [key] * len(parts), "no": [no for no, _ in parts], "text": [part for _, part in parts]}
                )

    # equal texts meet as equal chunks, so that no task gathers a whole text here
    cuts = work.staged(
        texts.mapInArrow(cut, "key string, no long, text string").groupBy("key", "no", "text").agg(F.lit(1).alias("one")),
        "bpe-chunks",
    )

    def pretokenise(batches):
        for batch in batches:
            found = [
                boundaries(text, no * chunk, chunk, overlap, pattern)
                for no, text in zip(batch["no"].to_pylist(), batch["text"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["no"],
                    pa.array([head for head, _ in found], pa.list_(pa.int64())),
                    pa.array([tail for _, tail in found], pa.list_(pa.int64())),
                ],
                ["key", "no", "head", "tail"],
            )

    def stitch(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("no")
        found = stitched(list(group["head"]), list(group["tail"]))
        out = pd.DataFrame({"of": group["key"].values, "at": group["no"].values})
        out["piece"] = [piece for piece, _ in found]
        out["begin"] = [begin for _, begin in found]
        # the text of a chunk reaches to the start of the next piece, or of the next chunk within a piece
        starts = [begin if begin >= 0 else no * chunk for no, (_, begin) in zip(out["at"], found)]
        out["begin"] = starts
        out["end"] = [*starts[1:], -1]
        return out

    bounds = cuts.select("key", "no", "text").mapInArrow(pretokenise, "key string, no long, head array<long>, tail array<long>")
    stitches = bounds.groupBy("key").applyInPandas(stitch, "of string, at long, piece long, begin long, end long")

    def encode(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("no")
        text = "".join(
            text[begin - no * chunk : None if end < 0 else end - no * chunk]
            for no, text, begin, end in zip(group["no"], group["text"], group["begin"], group["end"])
        )
        ids = _encoding(path, pattern).encode_ordinary(text)
        return pd.DataFrame({"key": group["key"].iloc[:1].values, "piece": group["piece"].iloc[:1].values, "ids": [ids]})

    pieces = (
        cuts.join(stitches, (F.col("key") == F.col("of")) & (F.col("no") == F.col("at")))
        .select("key", "no", "text", "piece", "begin", "end")
        .groupBy("key", "piece")
        .applyInPandas(encode, "key string, piece long, ids array<int>")
    )
    in_order = F.sort_array(F.collect_list(F.struct("piece", "ids")))
    return pieces.groupBy("key").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``doc`` (the input row) and ``ids`` (array<int>) of every row, by the ranks in the file ``path``."""

    @arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        return _id_lists(texts.to_pylist(), path, pattern)

    # else the planner may encode anew for each column made of the ids, such as their bytes
    ids_of = ids_of.asNondeterministic()

    work = Work(docs.sparkSession)
    rows = packed(docs, text=text)
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    short = rows.where(~is_long).select("doc", ids_of(F.coalesce("text", F.lit(""))).alias("ids"))
    long = rows.where(is_long).withColumn("key", F.sha2("text", 256))
    long_ids = work.staged(_long_ids(work, long.select("key", "text"), path, pattern, chunk, overlap), "bpe-long")
    joined = long.join(long_ids.withColumnRenamed("key", "of"), F.col("key") == F.col("of"), "inner")
    return short.unionByName(joined.select("doc", "ids"))


def decoded(ids, path: str) -> Column:
    """The raw bytes of an array of ids."""

    @arrow_udf("binary")
    def bytes_of(lists: pa.Array) -> pa.Array:
        return _joined_bytes(lists, path)

    return bytes_of(ids)
