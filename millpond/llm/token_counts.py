"""Operator 6: token counts from distinct pre-tokens, without ids.

Each text becomes its pre-tokens with their frequencies; each distinct
pre-token of the corpus is run through the merges once; the two are joined
and summed. Frequent pre-tokens (at least one in ``HEAD`` of all pairs of a
document and a pre-token, hence at most ``HEAD`` of them, of at most 64 bytes
or a digest) are broadcast. All others are joined by a shuffle, in which none
of them can be hot.

Where the file's normalizer and pre-tokenizer are those of ``_BY_WORDS``, a
word, cut at ASCII white space, is a unit for them, so they run once per
different word, and words of plain Latin characters, whose classes and case
need no tables, are split by a regular expression. With any other file they
run over whole texts. Special strings are pre-tokens of one token.

Defined cases: a NULL or empty text has 0 tokens; repeated rows are counted
one by one; an empty table gives an empty result; further columns travel in
``doc``, which holds all but the text.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from millpond.llm.common import Work, byte_words

#: At most so many pre-tokens are broadcast, some 50 MB if all were of the full length.
HEAD = 500_000
#: Words whose pre-tokens a worker remembers.
_REMEMBERED = 200_000
#: Words that need no normalizer: printable ASCII but the apostrophe, and Latin-1 letters.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
_PLAIN_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: The byte-level spelling of the letters beyond ASCII.
_SPELLED = {c: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}

# fixed values: the one normalizer and pre-tokenizer, as files state them, that drop white space, fold case and part
# letters, single digits and other signs, so that words can be taken one by one
_BY_WORDS = [
    {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
]

_PIECES = "array<struct<piece:string,n:long>>"


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple[Tokenizer, re.Pattern | None, bool]:
    """The tokenizer, its special strings, and whether words can be taken one by one."""
    tokenizer = Tokenizer.from_file(path)
    stated = json.loads(tokenizer.to_str())
    by_words = [stated["normalizer"], stated["pre_tokenizer"]] == _BY_WORDS
    special = [re.escape(token.content) for token in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, re.compile(f"({'|'.join(special)})") if special else None, by_words


def _split_word(tokenizer: Tokenizer, special: re.Pattern | None, word: str) -> list[str]:
    """The pre-tokens of one word, as the model sees them."""
    if _PLAIN.fullmatch(word) and not (special and special.search(word)):
        return [piece.translate(_SPELLED) for piece in _PLAIN_PIECE.findall(word.lower())]
    return _split(tokenizer, special, word)


def _split(tokenizer: Tokenizer, special: re.Pattern | None, text: str) -> list[str]:
    found = []
    for at, part in enumerate(special.split(text) if special else [text]):
        if at % 2:
            found.append(part)
        elif part:
            normal = tokenizer.normalizer.normalize_str(part) if tokenizer.normalizer else part
            parts = tokenizer.pre_tokenizer.pre_tokenize_str(normal) if tokenizer.pre_tokenizer else [(normal, None)]
            found += [piece for piece, _ in parts]
    return found


def _tokens(tokenizer: Tokenizer, special: re.Pattern | None, piece: str) -> int:
    return 1 if special and special.fullmatch(piece) else len(tokenizer.model.tokenize(piece))


def _frequencies(texts: list[str | None], path: str, known: dict[bytes, list[str]]) -> pa.Array:
    tokenizer, special, by_words = _tokenizer(path)
    ends, pieces, counts = [0], [], []
    for text in texts:
        words: Counter[bytes] = Counter()
        for some in byte_words((text or "").encode()) if by_words else ():
            words.update(some)
        own: dict[str, int] = {} if by_words else Counter(_split(tokenizer, special, text or ""))
        for word, n in words.items():
            split = known.get(word)
            if split is None:
                split = _split_word(tokenizer, special, word.decode())
                if len(known) >= _REMEMBERED:
                    known.clear()
                if len(word) <= 64:
                    known[word] = split
            for piece in split:
                own[piece] = own.get(piece, 0) + n
        pieces += own
        counts += own.values()
        ends.append(len(pieces))
    rows = pa.StructArray.from_arrays(
        [pa.array(pieces, pa.string()), pa.array(np.array(counts, np.int64))], names=["piece", "n"]
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def frequencies(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``id`` (of the row), ``doc`` (all columns but the text) and ``pieces`` with their counts."""
    known: dict[bytes, list[str]] = {}

    @arrow_udf(_PIECES)
    def pieces_of(texts: pa.Array) -> pa.Array:
        return _frequencies(texts.to_pylist(), path, known)

    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    return docs.select(F.struct(*others).alias("doc"), pieces_of(F.col(text)).alias("pieces")).withColumn(
        "id", F.monotonically_increasing_id()
    )


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``doc`` (all columns but the text) and ``n_tokens`` of every row, by the tokenizer file ``path``."""

    @arrow_udf("int")
    def tokens_of(pieces: pa.Array) -> pa.Array:
        tokenizer, special, _ = _tokenizer(path)
        return pa.array([_tokens(tokenizer, special, piece) for piece in pieces.to_pylist()], pa.int32())

    work = Work(docs.sparkSession)
    # written once: the ids of the rows are fixed from here on
    found = work.staged(frequencies(docs, path, text), "piece-counts")
    pairs = found.select("id", F.explode("pieces").alias("p")).select("id", "p.piece", "p.n")
    distinct = pairs.groupBy("piece").agg(F.count("*").alias("pairs"))
    key = F.when(F.octet_length("piece") <= 64, F.col("piece")).otherwise(F.concat(F.lit("sha256 "), F.sha2("piece", 256)))
    counted = work.staged(distinct.select(key.alias("of"), "pairs", tokens_of("piece").alias("tokens")), "piece-tokens")
    total = counted.agg(F.sum("pairs")).first()[0] or 0
    frequent = F.col("pairs") * HEAD >= F.lit(total)
    head = F.broadcast(counted.where(frequent).select("of", "tokens"))
    tail = counted.where(~frequent).select("of", F.col("tokens").alias("rare_tokens"))

    keyed = pairs.select("id", "n", key.alias("key")).join(head, F.col("key") == F.col("of"), "left").drop("of")
    common = keyed.where("tokens IS NOT NULL").select("id", (F.col("n") * F.col("tokens")).alias("part"))
    rare = (
        keyed.where("tokens IS NULL")
        .join(tail, F.col("key") == F.col("of"), "inner")
        .select("id", (F.col("n") * F.col("rare_tokens")).alias("part"))
    )
    sums = common.unionByName(rare).groupBy(F.col("id").alias("row")).agg(F.sum("part").alias("total"))
    return (
        found.select("id", "doc")
        .join(sums, F.col("id") == F.col("row"), "left")
        .select("doc", F.coalesce("total", F.lit(0)).cast("long").alias("n_tokens"))
    )
