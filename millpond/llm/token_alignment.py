"""Operator 12: token sequences of two tokenizers, aligned by the bytes they stand for.

1. Each text is encoded whole by both tokenizers. If the bytes of either
   sequence are not the text behind a space, the text has no tokens here.
2. Anchors: byte offsets where tokens of both sides end and the next token of
   both sides starts with a space. They part the sequences into windows of
   token ids, mostly one word each.
3. Equal windows of a batch are put together, and each different one is
   aligned once and remembered by its two id tuples: the groups between offsets
   where both sides end.
4. Pairs are counted over the corpus. Each text keeps its different pairs with
   their frequencies, so that a pair meets its count once per text. Frequent
   pairs (in at least one of ``HEAD`` of all (text, pair) rows, hence at most
   ``HEAD`` of them, 24 bytes each) are broadcast, and their rows are summed per
   text without a shuffle; the others are joined by one.

Defined cases: NULL and empty texts have no tokens; repeated texts count each
time; windows are remembered for speed only, the longest are aligned anew; an
empty table gives an empty result; further columns travel in ``doc``, which
holds all but the text.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers import Tokenizer

from millpond.llm.common import Work

#: At most so many pairs are broadcast.
HEAD = 200_000
#: Windows a worker remembers, and the most tokens of such a window.
_REMEMBERED, _SHORT = 300_000, 24
#: Between the packed ids of both sides; no id is as large.
_BETWEEN = b"\xff" * 4
#: Code points handed to a tokenizer at a time, but for one text that is longer.
_AT_A_TIME = 1 << 19

_ALIGNED = "struct<n_a:int,n_b:int,n_groups:int,groups:string,pairs:array<struct<pair:long,n:int>>>"

#: Characters up to here, whose classes no table will change, may be encoded by ranks; so may runs shorter than this.
_CHECKED, _RUN = 0x250, 2000
_UNCHECKED = re.compile(rf"[^\x00-\u{_CHECKED - 1:04x}]|\S{{{_RUN}}}|\s{{{_RUN}}}")
# fixed value: how byte-level tokenizers part a text
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# fixed values: the byte-level spelling writes these bytes as the characters of the same code points,
# and the others, in order, as the characters from code point 256 on
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _byte_of_character() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(_PRINTED)]
    return {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranked(tokenizer: Tokenizer, pieces: list[bytes]) -> tiktoken.Encoding | None:
    """The same encoding by ranks, several times faster, if the file is shown to allow it.

    Ranks merge two tokens wherever their bytes are one, the file's merges only
    if they name the two. With ids in the order of the merges, both agree if
    each token by itself is encoded as its own id: its last two parts are then
    those that its merge names, and no other two with its bytes can stand side
    by side when its turn comes, as merges within a token do not depend on what
    is around it. Which characters part words is compared for all of ``_CHECKED``.
    """
    stated = json.loads(tokenizer.to_str())
    model, parting = stated["model"], stated["pre_tokenizer"] or {}
    special = {token["id"] for token in stated["added_tokens"]}
    ids = [i for i in range(len(pieces)) if i not in special]
    plain = [model.get(c) for c in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")]
    if model.get("type") != "BPE" or any(plain) or stated["normalizer"] or model.get("ignore_merges") or model.get("byte_fallback"):
        return None
    if (parting.get("type"), parting.get("add_prefix_space"), parting.get("use_regex")) != ("ByteLevel", False, True):
        return None
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    in_order = all(x < y for x, y in zip(merged, merged[1:]))
    ranks = {pieces[i]: i for i in ids}
    if not in_order or len(ranks) != len(ids) or len(merged) + 256 != len(ids) or not all(bytes([b]) in ranks for b in range(256)):
        return None
    if not all([t.id for t in tokenizer.model.tokenize(token)] == [i] for token, i in model["vocab"].items() if i not in special):
        return None
    encoding = tiktoken.Encoding("ranked", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})
    for c in map(chr, range(_CHECKED)):
        probe = f" a{c}b {c}{c} 1{c}2 {c}'s.{c}. {c}\n{c}  {c}"
        if encoding.encode_ordinary(probe) != tokenizer.encode(probe, add_special_tokens=False).ids:
            return None
    return encoding


class Vocabulary:
    """A tokenizer file, the bytes of each of its ids, and how it encodes a text behind a space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task for each core
        if path.endswith(".model"):
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.pieces = [
                bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i)
                else model.id_to_piece(i).replace("▁", " ").encode()
                for i in range(model.get_piece_size())
            ]
            self._encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            tokenizer.no_truncation()
            tokenizer.no_padding()
            spelled = _byte_of_character()
            self.pieces = [b""] * (max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
            for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
                self.pieces[i] = bytes([spelled[c] for c in token])
            ranked = _ranked(tokenizer, self.pieces)

            def library(texts: list[str]) -> list[list[int]]:
                return [e.ids for e in tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]

            def encode(texts: list[str]) -> list[list[int]]:
                plain = [ranked is not None and not _UNCHECKED.search(t) for t in texts]
                others = iter(library([t for t, p in zip(texts, plain) if not p]))
                return [ranked.encode_ordinary(f" {t}") if p else next(others) for t, p in zip(texts, plain)]

            self._encode = encode
        self.sizes = np.array([len(piece) for piece in self.pieces], np.int64)
        self._bytes = np.frombuffer(b"".join(self.pieces), np.uint8)
        self._starts = np.cumsum(self.sizes) - self.sizes
        self.spaced = np.array([piece.startswith(b" ") for piece in self.pieces])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._encode(texts)

    def spelled(self, marks: str) -> list[str]:
        """Each id in decimal before each of some marks: those of id 0, of id 1, and so on."""
        return [f"{i}{mark}" for i in range(len(self.pieces)) for mark in marks]

    def spells(self, ids: np.ndarray, data: bytes) -> bool:
        """Whether the pieces of some ids, in a row, are these bytes."""
        sizes = self.sizes[ids]
        if int(sizes.sum()) != len(data):
            return False
        at = np.repeat(self._starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(data))
        return bool((self._bytes[at] == np.frombuffer(data, np.uint8)).all())


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def _spelled_pairs(left: Vocabulary, right: Vocabulary) -> list[str]:
    """Left ids before ',' and '|', then right ids before ',', ';' and a line end."""
    return left.spelled(",|") + right.spelled(",;\n")


def _places(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges that follow each other, the range of each position and the place in it."""
    which = np.repeat(np.arange(len(starts)), sizes)
    return which, np.arange(len(which)) - (np.cumsum(sizes) - sizes)[which]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def equal_windows(sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows with the same ids on all sides: one of each kind, and the kind of every window.

    A side has its ids, and where each window starts and ends. Hashes put
    windows together; their ids are compared, and a window that differs from
    the one it was put with is a kind of its own.
    """
    count = len(sides[0][1])
    hashes = np.zeros(count, np.uint64)
    placed = []
    for number, (ids, starts, ends) in enumerate(sides):
        which, place = _places(starts, ends - starts)
        placed.append((which, place))
        weights = _mixed(np.arange(1, int((ends - starts).max(initial=0)) + 1, dtype=np.uint64) + np.uint64(number << 32)) | np.uint64(1)
        parts = _mixed(ids.astype(np.uint64) + np.uint64(1)) * weights[place]
        hashes = _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + np.add.reduceat(parts, starts) + (ends - starts).astype(np.uint64))
    _, one, kind = np.unique(hashes, return_index=True, return_inverse=True)
    differs = np.zeros(count, bool)
    for (ids, starts, ends), (which, place) in zip(sides, placed):
        like = one[kind]
        differs |= (ends - starts) != (ends - starts)[like]
        other = np.minimum(starts[like][which] + place, len(ids) - 1)
        differs[which[ids != ids[other]]] = True
    own = np.flatnonzero(differs)
    kind[own] = len(one) + np.arange(len(own))
    return np.concatenate([one, own]), kind


def written_windows(
    left: Vocabulary, right: Vocabulary, all_a: np.ndarray, all_b: np.ndarray,
    bounds_a: tuple[np.ndarray, np.ndarray], bounds_b: tuple[np.ndarray, np.ndarray],
) -> list[str]:
    """The groups of each of some windows, given by where they lie, as text: cut wherever tokens of both sides end together."""
    if not len(bounds_a[0]):
        return []
    sides = []
    for ids, (starts, ends) in ((all_a, bounds_a), (all_b, bounds_b)):
        which, place = _places(starts, ends - starts)
        sides.append(ids[starts[which] + place])
    a, b = sides
    ends_a, ends_b = np.cumsum(left.sizes[a]), np.cumsum(right.sizes[b])
    at_b, at_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    shared_a, shared_b = ends_b[at_b] == ends_a, ends_a[at_a] == ends_b
    last = np.zeros(len(b), bool)
    last[np.cumsum(bounds_b[1] - bounds_b[0]) - 1] = True
    # the left tokens of a group stand before its right ones
    group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
    before_a = np.append(0, np.cumsum(np.bincount(group_b)))[group_a]
    before_b = np.cumsum(np.bincount(group_a))[group_b]
    line = np.empty(len(a) + len(b), np.int64)
    line[np.arange(len(a)) + before_a] = 2 * a + shared_a
    line[np.arange(len(b)) + before_b] = 2 * len(left.pieces) + 3 * b + shared_b + last
    spelled = _spelled_pairs(left, right)
    return "".join(map(spelled.__getitem__, line.tolist())).split("\n")[:-1]


def align(left: Vocabulary, right: Vocabulary, a: np.ndarray, b: np.ndarray, known: dict) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The windows of two sequences that spell the same bytes.

    Returns the groups of each different window as text, the number of each
    window's text, the left tokens up to the end of each window, and the pair of
    ids at each offset where both sides end with the left tokens up to there as
    the other part: ``(texts, numbers, ends, pairs)``, pairs having two columns.
    """
    ends_a, ends_b = np.cumsum(left.sizes[a]), np.cumsum(right.sizes[b])
    at_b = np.searchsorted(ends_b, ends_a)
    shared = ends_b[at_b] == ends_a
    both = np.flatnonzero(shared)
    pairs = np.stack([both + 1, a[both] << 32 | b[at_b[both]]], axis=1)
    # anchors: the next token of both sides starts with a space, or nothing follows
    shared[:-1] &= left.spaced[a[1:]] & right.spaced[b[np.minimum(at_b[:-1] + 1, len(b) - 1)]]
    ends = np.flatnonzero(shared) + 1
    ends_of_b = at_b[ends - 1] + 1
    starts, starts_of_b = np.append(0, ends[:-1]), np.append(0, ends_of_b[:-1])
    one, kind = equal_windows([(a, starts, ends), (b, starts_of_b, ends_of_b)])
    # a window's id tuples, packed into four bytes an id
    packed_a, packed_b = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
    bounds = zip(*((x[one] * 4).tolist() for x in (starts, ends, starts_of_b, ends_of_b)))
    keys = [packed_a[from_a:to_a] + _BETWEEN + packed_b[from_b:to_b] for from_a, to_a, from_b, to_b in bounds]
    texts = list(map(known.get, keys))
    new = [i for i, found in enumerate(texts) if found is None]
    if len(known) > _REMEMBERED:
        known.clear()
    which = one[new]
    for i, found in zip(new, written_windows(left, right, a, b, (starts[which], ends[which]), (starts_of_b[which], ends_of_b[which]))):
        texts[i] = found
        if len(keys[i]) <= 4 * _SHORT:
            known[keys[i]] = found
    return texts, kind, ends, pairs


def _runs(texts: list[str]):
    """The texts in lists of about ``_AT_A_TIME`` code points."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > _AT_A_TIME:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def _in_a_row(sides: list[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(sides), np.int64, sum(map(len, sides)))


def _aligned(texts: list[str | None], left_path: str, right_path: str, known: dict) -> pa.Array:
    left, right = vocabulary(left_path), vocabulary(right_path)
    n_a, n_b, n_groups, groups, values, counts, ends = [], [], [], [], [], [], [0]
    for run in _runs([text or "" for text in texts]):
        sides_a, sides_b = left.encode(run), right.encode(run)
        data = [b" " + text.encode() if text else b"" for text in run]
        for i, text in enumerate(run):
            if not text:
                sides_a[i] = sides_b[i] = []
        # all texts of the run in a row: each starts with a space, so no window crosses into the next
        a, b = _in_a_row(sides_a), _in_a_row(sides_b)
        if not (left.spells(a, b"".join(data)) and right.spells(b, b"".join(data))):
            for i in range(len(run)):
                if not (left.spells(_in_a_row([sides_a[i]]), data[i]) and right.spells(_in_a_row([sides_b[i]]), data[i])):
                    sides_a[i] = sides_b[i] = []
            a, b = _in_a_row(sides_a), _in_a_row(sides_b)
        tokens = np.cumsum([0, *map(len, sides_a)])
        if len(a):
            strings, kinds, window_ends, pairs = align(left, right, a, b, known)
        else:
            strings, kinds, window_ends, pairs = [], np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2), np.int64)
        windows = np.searchsorted(window_ends, tokens, side="right")
        links = np.searchsorted(pairs[:, 0], tokens, side="right")
        kinds = kinds.tolist()
        for i in range(len(run)):
            value, count = np.unique(pairs[links[i] : links[i + 1], 1], return_counts=True)
            n_a.append(len(sides_a[i]))
            n_b.append(len(sides_b[i]))
            n_groups.append(int(links[i + 1] - links[i]))
            groups.append(";".join(map(strings.__getitem__, kinds[windows[i] : windows[i + 1]])))
            values.append(value)
            counts.append(count)
            ends.append(ends[-1] + len(value))
    rows = pa.StructArray.from_arrays(
        [pa.array(np.concatenate([np.empty(0, np.int64), *values])), pa.array(np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int32))],
        names=["pair", "n"],
    )
    columns = [pa.array(c, pa.int32()) for c in (n_a, n_b, n_groups)]
    pairs_of = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
    return pa.StructArray.from_arrays(
        [*columns, pa.array(groups, pa.string()), pairs_of], names=["n_a", "n_b", "n_groups", "groups", "pairs"]
    )


def aligned(
    docs: DataFrame, left: str, right: str, text: str = "text", written: Callable[[F.Column], F.Column] = lambda groups: groups
) -> DataFrame:
    """``doc`` (all columns but the text), the aligned sequences of every row, and how its links stand in the corpus.

    ``left`` and ``right`` name tokenizer files (byte-level ``.json`` or
    ``.model``). ``groups`` are written ``a1,a2|b1;a3|b2,b3`` (ids of the left,
    of the right), '' without tokens. A link is the pair of tokens that ends a
    group: ``n_links`` of them, ``n_best`` with the highest corpus count of their
    right id, ``count_sum`` of their counts. ``written`` says what of the groups is kept, such as a
    digest, since they are longer than the texts.
    """
    known: dict = {}

    @arrow_udf(_ALIGNED)
    def aligned_of(texts: pa.Array) -> pa.Array:
        return _aligned(texts.to_pylist(), left, right, known)

    work = Work(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    found = docs.select(F.struct(*others).alias("doc"), aligned_of(F.col(text)).alias("a"))
    # written once: the keys of the rows are fixed from here on
    found = work.staged(found.select(F.monotonically_increasing_id().alias("key"), "doc", "a.*").withColumn("groups", written(F.col("groups"))), "aligned")
    links = found.select("key", F.explode("pairs").alias("p")).select("key", "p.pair", "p.n")
    counted = work.staged(
        links.groupBy("pair").agg(F.sum("n").alias("total"), F.count("*").alias("rows")), "pair-counts"
    )
    right_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    # one row for each id of the right tokenizer
    best = counted.groupBy(right_id.alias("of_right")).agg(F.max("total").alias("highest"))
    judged = work.staged(
        counted.join(best, right_id == F.col("of_right"), "inner").select(
            F.col("pair").alias("of"), "total", "rows", (F.col("total") == F.col("highest")).cast("long").alias("best")
        ),
        "pairs-judged",
    )
    every = judged.agg(F.sum("rows")).first()[0] or 0
    frequent = F.col("rows") * HEAD >= F.lit(every)
    head = F.broadcast(judged.where(frequent).drop("rows"))
    tail = judged.where(~frequent).drop("rows")

    met = links.join(head, F.col("pair") == F.col("of"), "left")
    rare = links.join(head.select("of"), F.col("pair") == F.col("of"), "left_anti").join(
        tail, F.col("pair") == F.col("of"), "inner"
    )
    parts = met.where("of IS NOT NULL").unionByName(rare)
    sums = parts.groupBy(F.col("key").alias("row")).agg(
        F.sum(F.col("n") * F.col("best")).alias("best"), F.sum(F.col("n") * F.col("total")).alias("total")
    )

    def whole(column) -> F.Column:
        return F.coalesce(F.col(column), F.lit(0)).cast("long")

    return found.join(sums, F.col("key") == F.col("row"), "left").select(
        "doc", "groups", *[whole(c).alias(c) for c in ("n_a", "n_b", "n_groups")], whole("n_groups").alias("n_links"),
        whole("best").alias("n_best"), whole("total").alias("count_sum"),
    )
