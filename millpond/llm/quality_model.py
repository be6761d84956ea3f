"""Operator 4: a quality classifier on random-indexing word vectors.

Words are hashed to ``BUCKETS`` rows. Each row has a fixed sparse random index
vector; its word vector is the sum of the index vectors of all words that ever
stand within ``REACH`` words of it, counted over the whole corpus in integers,
so that no order of tasks changes them. A document is pooled from its word
vectors: their mean, their spread, how alike neighbours are, and its length. A
two-layer network is trained with numpy on at most ``LABELLED`` labelled
documents (those with the smallest hashes of their identifiers), and its
logits are divided by a temperature fitted on a part it was not trained on.

Labels are learned only from documents whose crc32 of the identifier as text is
not a multiple of ``HOLDOUT``. Beside the text nothing enters a score.

Defined cases: NULL counts as an empty text, and an empty text is scored from
zero vectors; several labels of a document count as their smallest; without
labels of both kinds every score is the smoothed share of label 1; an empty
table gives an empty result; further columns travel in ``doc``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millpond.llm.common import Work, byte_words

BUCKETS, DIMENSIONS, NONZERO, REACH = 1 << 15, 64, 4, 2
#: Labelled documents that the network is fitted on at most.
LABELLED = 20_000
HOLDOUT = 5
#: Signs that are words of their own.
SIGNS = b"!?,.;:#*$%&|<>\"()"
#: Rows of the word vectors that travel together.
_BLOCK = 64
FEATURES = 2 * DIMENSIONS + REACH + 1


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) % BUCKETS
        return value


def word_ids(text: str | None, known: _Buckets) -> np.ndarray:
    """Buckets of the words of a text, signs apart."""
    data = (text or "").encode()
    for sign in SIGNS:
        one = bytes([sign])
        if one in data:
            data = data.replace(one, b" " + one + b" ")
    parts = [np.fromiter(map(known.__getitem__, some), np.int64, len(some)) for some in byte_words(data)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def index_vectors(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of each row's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIMENSIONS, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def add_contexts(sums: np.ndarray, texts: list[np.ndarray], index: tuple[np.ndarray, np.ndarray]) -> None:
    """Add the index vectors of the neighbours of each word to its row of ``sums`` (whole numbers)."""
    places, signs = index
    ids, text = np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for distance in range(1, REACH + 1):
        near = np.flatnonzero(text[distance:] == text[: len(text) - distance])
        for low in range(0, len(near), 1 << 18):
            a, b = ids[near[low : low + (1 << 18)]], ids[near[low : low + (1 << 18)] + distance]
            for word, other in ((a, b), (b, a)):
                at = (word[:, None] * DIMENSIONS + places[other]).ravel()
                sums += np.bincount(at, signs[other].ravel(), sums.size)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The features of a document from the vectors of its words."""
    out = np.zeros(FEATURES)
    n = len(ids)
    if n:
        total, squares, alike = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(REACH)
        for low in range(0, n, 1 << 16):
            some = vectors[ids[low : low + (1 << 16) + REACH]]
            own = some[: 1 << 16]
            total += own.sum(axis=0, dtype=np.float64)
            squares += (own * own).sum(axis=0, dtype=np.float64)
            for distance in range(1, REACH + 1):
                ahead = some[distance : distance + (1 << 16)]
                alike[distance - 1] += (own[: len(ahead)] * ahead).sum(dtype=np.float64)
        mean = total / n
        out[:DIMENSIONS] = mean
        out[DIMENSIONS : 2 * DIMENSIONS] = np.sqrt(np.maximum(squares / n - mean * mean, 0))
        out[2 * DIMENSIONS : -1] = alike / n
    out[-1] = np.log1p(n)
    return out


def word_vectors(work: Work, texts: DataFrame) -> np.ndarray:
    """Rows of length one (zero for words never seen) from the contexts in all ``text``."""

    def contexts(batches):
        known, index = _Buckets(), index_vectors()
        sums, texts, words = np.zeros(BUCKETS * DIMENSIONS), [], 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                texts.append(word_ids(text, known))
                words += len(texts[-1])
                if words >= 1 << 19:
                    add_contexts(sums, texts, index)
                    texts, words = [], 0
        if texts:
            add_contexts(sums, texts, index)
        rows = sums.astype(np.int64).reshape(-1, _BLOCK * DIMENSIONS)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(used), "sums": pa.array([rows[b].tobytes() for b in used], pa.binary())})

    def merged(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch["block"].to_pylist(), batch["sums"].to_pylist()):
                part = np.frombuffer(sums, np.int64)
                found[block] = found[block] + part if block in found else part
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(list(found), pa.int64()), "sums": pa.array([v.tobytes() for v in found.values()], pa.binary())}
        )

    kind = "block long, sums binary"
    # every task gives each block at most once; the blocks of all tasks are added up as they stream in
    blocks = work.staged(texts.mapInArrow(contexts, kind).repartition("block").mapInArrow(merged, kind), "word-vectors")
    sums = np.zeros((BUCKETS // _BLOCK, _BLOCK * DIMENSIONS))
    for row in blocks.toLocalIterator():  # BUCKETS * DIMENSIONS numbers, whatever the corpus
        sums[row["block"]] = np.frombuffer(row["sums"], np.int64)
    sums = sums.reshape(BUCKETS, DIMENSIONS)
    seen = np.abs(sums).sum(axis=1) > 0
    sums[seen] /= np.sqrt((sums[seen] ** 2).sum(axis=1, keepdims=True))
    if seen.any():
        # what all words share, the company of the most frequent ones, tells nothing
        sums[seen] -= sums[seen].mean(axis=0)
        sums[seen] /= np.maximum(np.sqrt((sums[seen] ** 2).sum(axis=1, keepdims=True)), 1e-12)
    return sums.astype(np.float32)


class Network:
    """Two layers, trained by Adam on cross entropy; probabilities calibrated by a temperature."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 3):
        self.prior = (labels.sum() + 1) / (len(labels) + 2)
        self.trained = 0 < labels.sum() < len(labels)
        if not self.trained:
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(labels))
        held = max(1, len(labels) // 6)
        calibration, fit = order[:held], order[held:]
        self.centre, self.scale = features[fit].mean(axis=0), features[fit].std(axis=0) + 1e-6
        x, y = (features - self.centre) / self.scale, labels.astype(float)
        weights = [
            rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
            rng.normal(0, 1 / np.sqrt(hidden), hidden), np.array(np.log(self.prior / (1 - self.prior))),
        ]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
                step += 1
                inner = np.tanh(x[batch] @ weights[0] + weights[1])
                wrong = (1 / (1 + np.exp(-(inner @ weights[2] + weights[3]))) - y[batch]) / len(batch)
                back = np.outer(wrong, weights[2]) * (1 - inner**2)
                slopes = [x[batch].T @ back + 1e-4 * weights[0], back.sum(axis=0), inner.T @ wrong + 1e-4 * weights[2], wrong.sum()]
                for i, slope in enumerate(slopes):
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    weights[i] = weights[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = weights
        logits, truth = self._logits(features[calibration]), y[calibration]

        def loss(temperature: float) -> float:
            z = logits / temperature
            return float(np.mean(np.logaddexp(0, z) - truth * z))

        self.temperature = min(np.geomspace(0.25, 16, 121), key=loss)

    def _logits(self, features: np.ndarray) -> np.ndarray:
        inner = np.tanh((features - self.centre) / self.scale @ self.weights[0] + self.weights[1])
        return inner @ self.weights[2] + self.weights[3]

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._logits(features) / self.temperature, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLDOUT == 0, F.lit(False))


def scored(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    doc_id: str = "doc_id",
    quality: str = "quality",
    text: str = "text",
) -> DataFrame:
    """``doc`` (the input row), ``held_out``, ``score`` and ``predicted`` of every row."""
    work = Work(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(work, docs.select(F.col(text).alias("text"))))
    known = _Buckets()

    def features_of(texts: list[str | None]) -> np.ndarray:
        return np.array([pooled(word_ids(t, known), vectors.value) for t in texts]).reshape(-1, FEATURES)

    @arrow_udf("binary")  # a kilobyte a row on the driver, not a list of numbers
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([row.tobytes() for row in features_of(texts.to_pylist())], pa.binary())

    chosen = (
        labels.where(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("of_id"))
        .agg(F.min(quality).alias("label"))
        .orderBy(F.xxhash64("of_id"), "of_id")
        .limit(LABELLED)
    )
    sample = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), F.col("id") == F.col("of_id"))  # at most LABELLED rows
        .groupBy("id")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("label").alias("label"))
        .select("id", "label", features("text").alias("features"))
    )
    rows = sorted(sample.collect(), key=lambda row: row["id"])
    found = np.frombuffer(b"".join(r["features"] for r in rows)).reshape(-1, FEATURES)
    network = Network(found, np.array([r["label"] for r in rows]))

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(network.scores(features_of(texts.to_pylist())))

    found = docs.select(F.struct("*").alias("doc"), held_out(F.col(doc_id)).alias("held_out"), score(F.col(text)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
