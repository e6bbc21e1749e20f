"""Language identification by error-correcting output codes over byte n-grams.

Every learned language gets a codeword of bits; for each bit a binary classifier tells, from the hashed
byte bigrams and trigrams of a text, on which side of the bit its language stands. A classifier is a
naive Bayes model of the two sides. All of them come from one table of n-gram counts by language, which
Spark adds up over all training texts (its size is languages times buckets, checked against
``MAX_LANGUAGES``). Decoding weighs the logistic loss of each bit by how surely that bit is read on training
texts, takes the codeword of least loss, and flags a text as ambiguous where the runner-up is close.

Defined results
    Null text, or a text without any letter: ``und``, score 0, not ambiguous. Nothing to learn from:
    ``und`` for all. A single learned language: that one, score 1. Equal losses: the smaller name.
    Rows of null language or null text teach nothing. Repeated rows count each. Null doc_id: counted
    in the fold of the empty text. No rows: no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.sampling import fold
from pitchlake.llm.text import blocks, mix, texts

BUCKETS = 1 << 13
MAX_LANGUAGES = 4096
UNKNOWN = "und"
CLOSE = 0.6  # probability of the best language below which a text is ambiguous

_FOLD = np.full(256, 32, np.uint8)  # ASCII but letters: one space
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte bigram and trigram, and index of its text; runs of spaces count once."""
    x = _FOLD[data]
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    again = np.append(False, (x[1:] == 32) & (x[:-1] == 32) & (row[1:] == row[:-1]))
    if again.any():
        x, row = x[~again], row[~again]
    wide = x.astype(np.uint32)
    two = wide[:-1] * np.uint32(256) + wide[1:]
    three = two[:-1] * np.uint32(256) + wide[2:]
    parts, rows = [], []
    for code, size, seed in ((two, 2, 1 << 24), (three, 3, 1 << 25)):
        h = (code + np.uint32(seed)) * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
        h *= np.uint32(2246822519)
        same = row[size - 1:] == row[: 1 - size]
        parts.append((h >> np.uint32(19)).astype(np.int64)[same])
        rows.append(row[size - 1:][same])
    return np.concatenate(parts), np.concatenate(rows)


def counted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of buckets, a row for each text."""
    rows = len(offsets) - 1
    bucket, row = grams(data, offsets)
    return np.bincount(row * np.int64(BUCKETS) + bucket, minlength=rows * BUCKETS).reshape(rows, BUCKETS)


def small_blocks(offsets: np.ndarray, rows: int = 64) -> Iterator[tuple[int, int]]:
    for first, last in blocks(offsets, 1 << 20):
        for at in range(first, last, rows):
            yield at, min(at + rows, last)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        lang = np.array(batch.column("lang").to_pylist(), object)
        for first, last in small_blocks(offsets):
            found = counted(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
            for name in set(lang[first:last]):
                sums = found[lang[first:last] == name].sum(axis=0)
                total[name] = total[name] + sums if name in total else sums
    for name, sums in total.items():
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(sums[used], pa.int64())],
            ["lang", "bucket", "n"],
        )


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 per language: rows far apart, no bit the same for all, drawn by a fixed seed."""
    if languages == 2:
        return np.array([[1, 1, 1], [-1, -1, -1]])
    bits = max(15, 6 * int(np.ceil(np.log2(max(languages, 2)))))
    best, least = np.ones((languages, bits), int), -1
    rng = np.random.default_rng(11)
    for _ in range(200 if languages <= 64 else 5):
        code = np.where(rng.random((languages, bits)) < 0.5, -1, 1)
        flat = np.abs(code.sum(axis=0)) == languages
        code[0, flat] *= -1
        apart = (bits - code @ code.T) // 2 + bits * np.eye(languages, dtype=int)
        if apart.min() > least:
            best, least = code, apart.min()
    return best


class Codes:
    """Names, codewords, a weight for each n-gram and bit, and how much each bit counts."""

    def __init__(self, names: list[str], counts: np.ndarray) -> None:
        self.names = names
        self.code = codewords(len(names))
        self.weight = np.zeros((BUCKETS, self.code.shape[1]), np.float32)
        if len(names) > 1:
            for bit in range(self.code.shape[1]):
                side = [counts[self.code[:, bit] == s].sum(axis=0) + 0.5 for s in (1, -1)]
                log = [np.log(s / s.sum()) for s in side]
                self.weight[:, bit] = log[0] - log[1]
            # A bit counts by the mean margin with which it tells its two sides apart.
            share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
            margin = (share @ self.weight) * self.code
            self.sure = np.maximum(margin.min(axis=0), 0.01)
            self.sure = self.sure / self.sure.sum()
        else:
            self.sure = np.ones(self.code.shape[1])

    def __call__(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its probability and whether the text is ambiguous, for each row."""
        if len(self.names) == 1:
            return np.zeros(len(counts), int), np.ones(len(counts)), np.zeros(len(counts), bool)
        n = counts.sum(axis=1, keepdims=True)
        # The margin of a text grows with the root of its length: neighbouring n-grams tell the same.
        read = (counts.astype(np.float32) @ self.weight) / np.sqrt(np.maximum(n, 1))
        loss = (np.logaddexp(0, -read[:, None, :] * self.code) * self.sure).sum(axis=2)
        order = np.argsort(loss, axis=1, kind="stable")
        likely = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 4)
        likely = likely.max(axis=1) / likely.sum(axis=1)
        return order[:, 0], likely, likely < CLOSE


def learn(rows: DataFrame) -> Codes | None:
    """The codes from (text, lang) rows; None where there is no language."""
    sums = (
        rows.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
        .mapInArrow(_sums, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    names = sorted(r["lang"] for r in sums.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the counts would not fit in memory")
    if not names:
        return None
    held = sums.toArrow()
    place = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(names), BUCKETS))
    counts[[place[x] for x in held.column("lang").to_pylist()], held.column("bucket").to_numpy()] = held.column("n").to_numpy()
    return Codes(names, counts)


def identify(
    documents: DataFrame, held_parts: int = 5, held_part: int = 0,
    doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every document."""
    held = fold("doc_id", held_parts) == held_part
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    codes = documents.sparkSession.sparkContext.broadcast(learn(rows.where(~held)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codes.value
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            best = np.zeros(len(batch), int)
            score, close = np.zeros(len(batch)), np.zeros(len(batch), bool)
            for first, last in small_blocks(offsets) if model else ():
                best[first:last], score[first:last], close[first:last] = model(
                    counted(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
                )
            unknown = ~letters if model else np.ones(len(batch), bool)
            names = np.array(model.names if model else [UNKNOWN], object)[best]
            names[unknown] = UNKNOWN
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(unknown, 0.0, score)),
                 pa.array(close & ~unknown)],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return rows.select("doc_id", "text", letters).mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean"
    ).select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")
