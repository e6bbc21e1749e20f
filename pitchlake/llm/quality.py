"""Quality from random-indexing word vectors, pooled per document, and a small calibrated network.

Every word (lower-cased run of letters and digits, or run of punctuation) falls into one of ``BUCKETS``
places by its hash. A place has a sparse ternary index vector made from its number; its word vector is
the sum of the index vectors of all words at most two away, over all texts. These sums are added up
in Spark; the finished vectors have a fixed size (4 MB) and are broadcast. A document is the mean and
the spread of its word vectors. A network of two layers, in numpy, learns from the labelled rows (at
most about ``MAX_LABELLED``, a documented bound); a temperature fitted on a part that it did not learn from
makes its probabilities honest. Vectors and scores cover all texts, whole.

Defined results
    A null or empty text has no words: its pooled vector is zero and is scored like any other.
    No labels of both kinds to learn from: every score is the share of ones, or 0 without labels.
    Several labels of an id: the larger counts. Repeated documents are scored each. Null doc_id: kept,
    never used for learning. No rows: no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm import sampling
from pitchlake.llm.text import MARKED, blocks, mix, texts, tokens

BUCKETS = 1 << 15
DIM = 32
REACH = 2
NONZERO = 2
MAX_LABELLED = 12_000
HIDDEN = 32
THRESHOLD = 0.7
INPUTS = 2 * DIM + 3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    drawn = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(1)).reshape(BUCKETS, NONZERO)
    places = (drawn % np.uint64(DIM)).astype(np.int64)
    return places, np.where(drawn >> np.uint64(63), 1, -1).astype(np.int64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word and index of its text, in order."""
    found = tokens(data, offsets, MARKED)
    return (found.hash & np.uint64(BUCKETS - 1)).astype(np.int64), found.text


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    total = np.zeros(BUCKETS * DIM)
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        for first, last in blocks(offsets):
            word, row = words(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
            for gap in range(1, REACH + 1):
                same = row[gap:] == row[:-gap]
                left, right = word[:-gap][same], word[gap:][same]
                for a, b in ((left, right), (right, left)):
                    for i in range(NONZERO):
                        total += np.bincount(a * DIM + places[b, i], signs[b, i], BUCKETS * DIM)
    total = total.reshape(BUCKETS, DIM).astype(np.int64)
    used = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), *[pa.array(total[used, i]) for i in range(DIM)]], ["bucket", *_columns()]
    )


def _columns() -> list[str]:
    return [f"c{i}" for i in range(DIM)]


def word_vectors(documents: DataFrame, text: str = "text") -> np.ndarray:
    """Unit vectors of all buckets, from the contexts in all texts."""
    sums = (
        documents.select(F.col(text).alias("text"))
        .mapInArrow(_contexts, "bucket long, " + ", ".join(f"{c} long" for c in _columns()))
        .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in _columns()])
    )
    made = np.zeros((BUCKETS, DIM), np.float32)
    held = sums.toArrow()  # at most BUCKETS rows
    made[held.column("bucket").to_numpy()] = np.stack([held.column(c).to_numpy() for c in _columns()], axis=1)
    size = np.linalg.norm(made, axis=1, keepdims=True)
    return made / np.maximum(size, 1e-9)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A row of ``INPUTS`` numbers for each text: mean and spread of its vectors, length, repetition."""
    rows = len(offsets) - 1
    out = np.zeros((rows, INPUTS), np.float32)
    for first, last in blocks(offsets, 1 << 20):
        word, row = words(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
        if not len(word):
            continue
        at = np.flatnonzero(np.diff(row, prepend=-1))
        n = np.diff(np.append(at, len(row)))[:, None]
        vector = vectors[word]
        mean = np.add.reduceat(vector, at, axis=0) / n
        spread = np.sqrt(np.maximum(np.add.reduceat(vector * vector, at, axis=0) / n - mean * mean, 0))
        # How much a text repeats itself: words followed by themselves, and squares of the words' shares.
        same = np.append((word[1:] == word[:-1]) & (row[1:] == row[:-1]), False).astype(float)
        key = np.unique(row * BUCKETS + word, return_counts=True)
        again = np.bincount(key[0] // BUCKETS, key[1].astype(float) ** 2, last - first)
        out[first + row[at]] = np.concatenate(
            [mean, spread, np.log1p(n) / 10, again[row[at]][:, None] / (n * n), np.add.reduceat(same, at)[:, None] / n],
            axis=1,
        )
    return out


class Network:
    """Two layers in numpy, fitted by Adam, with a temperature for its log-odds."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.temperature = 1.0
        self.layers = [
            rng.normal(0, (2 / INPUTS) ** 0.5, (INPUTS, HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(1),
        ]
        apart = np.zeros(len(x), bool)
        apart[rng.permutation(len(x))[: len(x) // 5]] = True
        self._learn(self._scaled(x[~apart]), y[~apart], epochs, rng)
        self._calibrate(self._odds(self._scaled(x[apart])), y[apart])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8)

    def _odds(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.layers
        return np.maximum(x @ w + b, 0) @ v + c[0]

    def _learn(self, x: np.ndarray, y: np.ndarray, epochs: int, rng: np.random.Generator) -> None:
        m = [np.zeros_like(p) for p in self.layers]
        s = [np.zeros_like(p) for p in self.layers]
        step = 0
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
                w, b, v, c = self.layers
                before = x[at] @ w + b
                hidden = np.maximum(before, 0)
                g = (1 / (1 + np.exp(-np.clip(hidden @ v + c[0], -30, 30))) - y[at]) / len(at)
                back = np.outer(g, v) * (before > 0)
                grads = [x[at].T @ back + 1e-4 * w, back.sum(axis=0), hidden.T @ g + 1e-4 * v, g.sum(keepdims=True)]
                step += 1
                for i, grad in enumerate(grads):
                    m[i] += 0.1 * (grad - m[i])
                    s[i] += 0.001 * (grad * grad - s[i])
                    change = m[i] / (1 - 0.9**step) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)
                    self.layers[i] = self.layers[i] - 0.003 * change

    def _calibrate(self, odds: np.ndarray, y: np.ndarray) -> None:
        if len(y):
            tried = np.exp(np.linspace(-1.5, 2.5, 81))
            loss = [np.logaddexp(0, np.where(y == 1, -odds, odds) / t).mean() for t in tried]
            self.temperature = float(tried[int(np.argmin(loss))])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._odds(self._scaled(x)) / self.temperature, -35, 35)))


def _pool(batches: Iterator[pa.RecordBatch], vectors) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = pooled(*texts(batch.column("text")), vectors.value)
        column = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), INPUTS).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([column, batch.column("y"), batch.column("k")], ["x", "y", "k"])


def fit(rows: DataFrame, vectors) -> Network | float:
    """The network, from bounded (text, y) rows; a plain share where there is only one label."""
    asked = rows.select("text", "y", F.xxhash64("doc_id", "text").alias("k"))
    found = asked.mapInArrow(lambda b: _pool(b, vectors), "x array<float>, y int, k long").orderBy("k", "y", "x").toArrow()
    y = found.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    x = found.column("x").combine_chunks().flatten().to_numpy().reshape(-1, INPUTS)
    return Network(x.astype(np.float64), y)


def scorer(
    documents: DataFrame, labels: DataFrame, held_parts: int = 4, held_part: int = 2,
    max_labelled: int = MAX_LABELLED,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
):
    """A function that adds a score column to any frame with a text column, learned from ``documents``."""
    context = documents.sparkSession.sparkContext
    held = sampling.fold("doc_id", held_parts) == held_part
    vectors = context.broadcast(word_vectors(documents, text))
    chosen = sampling.training_labels(labels, "doc_id", label, max_labelled, held)
    model = context.broadcast(fit(sampling.with_labels(documents, doc_id, text, chosen), vectors))

    def score(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(*texts(batch.column(text)), vectors.value)
            made = np.full(len(x), model.value) if isinstance(model.value, float) else model.value(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.float64())], [*batch.schema.names, column]
            )

    def apply(frame: DataFrame, column: str) -> DataFrame:
        schema = T.StructType([*frame.schema.fields, T.StructField(column, T.DoubleType())])
        return frame.mapInArrow(lambda b: score(b, column), schema)

    return apply


def quality(
    documents: DataFrame, labels: DataFrame, held_parts: int = 4, held_part: int = 2,
    max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    apply = scorer(documents, labels, held_parts, held_part, max_labelled, doc_id, text, label)
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias(text))
    held = sampling.fold("doc_id", held_parts) == held_part
    return apply(rows, "score").select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text", **options,
) -> DataFrame:
    """The rows of ``documents``, all their columns, that are not rejected."""
    apply = scorer(documents, labels, doc_id=doc_id, text=text, **options)
    column = "quality_score"
    while column in documents.columns:
        column += "_"
    return apply(documents, column).where(F.col(column) >= threshold).drop(column)
