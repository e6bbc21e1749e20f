"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: every word, every pair of neighbours, and every pair with one word between, each
hashed to 2^20 places, present or not. FTRL-proximal keeps a learning rate per coordinate, and its L1
term leaves most weights at exactly zero; only the others are broadcast. It reads the labelled rows
in one task, in order of a hash: at most about ``MAX_LABELLED`` of them, a documented bound. Scoring
covers all texts, whole.

Defined results
    Words are runs of letters, digits and bytes beyond ASCII, A-Z lowered; other bytes separate.
    A null or empty text has no features and scores what the bias says. No labels of both kinds to
    learn from: every score is the share of ones, or 0 without labels.
    Several labels of an id: the larger counts. Repeated documents are scored each. Null doc_id: kept,
    never used for learning. No rows: no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import sampling
from pitchlake.llm.text import WORDS, blocks, mix, texts, token_bounds, tokens

PLACES = 1 << 20
MAX_LABELLED = 12_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.4, 1.0, 10.0, 1.0


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts, in order of the texts: place, and index of the text."""
    found = tokens(data, offsets, WORDS)
    h, row = found.hash, found.text
    made, rows = [h], [row]
    for gap, seed in ((1, 0x51ED270B0A1F39C1), (2, 0x2545F4914F6CDD1D)):
        same = row[gap:] == row[:-gap]
        made.append((mix(h[:-gap] + np.uint64(seed)) ^ h[gap:])[same])
        rows.append(row[gap:][same])
    places = (mix(np.concatenate(made)) & np.uint64(PLACES - 1)).astype(np.int64)
    return places, np.concatenate(rows)


def distinct(places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once per text, in order of the texts."""
    key = np.unique(rows.astype(np.int64) * PLACES + places)
    return key % PLACES, key // PLACES


class Ftrl:
    """FTRL-proximal over binary features, place 0 to PLACES-1, with a bias that has no L1."""

    def __init__(self) -> None:
        self.z = np.zeros(PLACES)
        self.n = np.zeros(PLACES)
        self.bias, self.bias_n = 0.0, 1.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum() + self.bias, -35, 35)))
        g = p - y
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown
        self.bias_n += g * g
        self.bias -= 0.5 * g / np.sqrt(self.bias_n)


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Non-zero weights and the bias from (doc_id, text, y); ``rows`` are bounded."""
    one = rows.select(F.xxhash64("doc_id", "text").alias("k"), "text", "y").repartition(1)
    found = one.sortWithinPartitions("k", "text", "y").mapInArrow(_fit, "place long, weight double").collect()
    places = np.array([r["place"] for r in found if r["place"] >= 0], np.int64)
    values = np.array([r["weight"] for r in found if r["place"] >= 0])
    bias = next((r["weight"] for r in found if r["place"] < 0), -35.0)
    return places, values, bias


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples: list[tuple[np.ndarray, int]] = []
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        y = batch.column("y").to_numpy(zero_copy_only=False)
        for first, last in blocks(offsets):
            part = data[offsets[first]: offsets[last]]
            place, row = distinct(*features(part, offsets[first: last + 1] - offsets[first]))
            cut = np.searchsorted(row, np.arange(last - first + 1))
            examples += [(place[cut[i]: cut[i + 1]].astype(np.int32), int(y[first + i])) for i in range(last - first)]
    ones = sum(y for _, y in examples)
    place, weight = np.zeros(0, np.int64), np.zeros(0)
    if 0 < ones < len(examples):
        model = Ftrl()
        model.bias = float(np.log(ones / (len(examples) - ones)))
        for _ in range(EPOCHS):
            for at, y in examples:
                model.learn(at, y)
        weight = model.weights(np.arange(PLACES))
        place = np.flatnonzero(weight)
        weight, bias = weight[place], model.bias
    else:
        bias = 35.0 if ones else -35.0
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(place, -1), pa.int64()), pa.array(np.append(weight, bias))], ["place", "weight"]
    )


def toxicity(
    documents: DataFrame, labels: DataFrame, held_parts: int = 4, held_part: int = 2,
    max_labelled: int = MAX_LABELLED, threshold: float = 0.3,
    doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = documents.sparkSession
    held = sampling.fold("doc_id", held_parts) == held_part
    chosen = sampling.training_labels(labels, "doc_id", label, max_labelled, held)
    model = spark.sparkContext.broadcast(fit(sampling.with_labels(documents, doc_id, text, chosen)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, bias = model.value
        weight = np.zeros(PLACES)
        weight[places] = values
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            total = np.full(len(batch), bias)
            for first, last in blocks(offsets):
                part = data[offsets[first]: offsets[last]]
                place, row = features(part, offsets[first: last + 1] - offsets[first])
                used = weight[place] != 0
                place, row = distinct(place[used], row[used])
                total[first:last] += np.bincount(row, weight[place], last - first)
            scores = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
