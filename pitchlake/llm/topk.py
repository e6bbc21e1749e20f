"""Exact top-k search by integer inner product: tiles, partial selection, tree merging.

Queries come in blocks of about ``QUERY_BLOCK`` vectors, each block broadcast in turn (its size is
fixed); the lists of a block are written before the next one comes, so the driver and the executors hold one
block at a time. Candidates stay where they are read. A task multiplies a block with tiles of its candidates,
keeps the best k of each query over all its tiles, and the short lists meet in two levels.

Defined results
    A vector that is null, or holds a null or non-finite component, takes no part.
    Vectors meet only vectors of the same length; an empty vector scores 0 with other empty ones.
    Equal scores go to the smaller id. All rows of a query's own id are left out of its list.
    A null id takes no part. A query id that occurs on several rows is asked once, with the smallest
    of its vectors; as candidates repeated rows each count. Fewer than k candidates: all of them.
    No rows: no rows. Scores beyond a long raise an error. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.store import written

QUERY_BLOCK = 4096
TILE = 4096
SCALE = 256
MERGE = 64  # partial lists of this many tasks meet first
EXACT = 2.0**53


def usable(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.col(vector).isNotNull() & good


def prepared(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Usable rows as (id, v)."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    return rows.where(F.col("id").isNotNull() & usable("v"))


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component: whole numbers held as doubles, or as Python ints beyond these."""
    if np.abs(vectors).max(initial=0) < np.finfo(float).max / SCALE:
        return np.floor(vectors * SCALE)
    # A double that large is a whole number itself.
    exact = np.vectorize(lambda x: int(x) * SCALE if abs(x) >= EXACT else math.floor(x * SCALE), otypes=[object])
    return exact(vectors)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: as doubles if these hold them, else as Python ints."""
    if not len(q) or not len(c):
        return q @ c.T
    if q.dtype != object and c.dtype != object:
        if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1) < EXACT:
            return q @ c.T
    exact = np.vectorize(int, otypes=[object])
    return exact(q) @ exact(c).T


class Best:
    """The best k of each query so far, ordered by score, then id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.k = ids[order], vectors[order], k
        self.lists: list[list[tuple[int, int]]] = [[] for _ in ids]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        for first in range(0, len(ids), TILE):
            self._tile(ids[first: first + TILE], vectors[first: first + TILE])

    def _tile(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        score = products(self.vectors, vectors)
        for i in np.flatnonzero(np.isin(self.ids, ids)):
            score[i, ids == self.ids[i]] = -np.inf
        at = max(len(ids) - self.k, 0)
        least = np.partition(score, at, axis=1)[:, at]
        for i, row in enumerate(score):
            floor = least[i]
            if len(self.lists[i]) == self.k:
                floor = max(floor, -self.lists[i][-1][0])
            near = np.flatnonzero((row >= floor) & (row > -np.inf))
            if len(near):
                # The tile is in order of its ids, so a stable sort leaves ties with the smaller id.
                best = near[np.argsort(-row[near], kind="stable")[: self.k]]
                found = self.lists[i] + [(-int(row[j]), int(ids[j])) for j in best]
                self.lists[i] = sorted(found)[: self.k]


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, by length of the vectors."""
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    column = batch.column("v")
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield int(n), ids[rows], values[start[rows][:, None] + np.arange(n)]


def exact_top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 5,
    vec_id: str = "vec_id", vector: str = "embedding", query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product of every query.

    Each component x counts as floor(256 * x).
    """
    spark = candidates.sparkSession
    asked = prepared(queries, vec_id, vector).groupBy("id").agg(F.min("v").alias("v"))
    rows = prepared(candidates, vec_id, vector)
    total = asked.count()
    made = None
    count = max(1, -(-total // query_block))
    for block in range(count):
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(count)) == block) if count > 1 else asked
        packed = mine.toArrow().combine_chunks()  # a block of the stated queries
        held = spark.sparkContext.broadcast({
            n: (ids, vectors) for batch in packed.to_batches() for n, ids, vectors in _matrix(batch)
        })
        part = rows.mapInArrow(_search(held, k), PARTIAL)
        if count > 1:
            part = written(part, "topk-block")
            held.unpersist()
        made = part if made is None else made.unionByName(part)
    return merged(made, k)


PARTIAL = "query_id long, vec_id long, score long, part long"


def _search(held, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best = {n: Best(ids, whole(vectors), k) for n, (ids, vectors) in held.value.items()}
        for batch in batches:
            for n, ids, vectors in _matrix(batch):
                if n in best:
                    best[n].add(ids, whole(vectors))
        part = TaskContext.get().partitionId() // MERGE
        out = [
            (int(q), j, -s, part)
            for b in best.values() for q, found in zip(b.ids, b.lists, strict=True) for s, j in found
        ]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in columns], ["query_id", "vec_id", "score", "part"]
        )

    return search


def merged(partial: DataFrame, k: int) -> DataFrame:
    """The best k of each query, over groups of tasks first, then over all."""
    order = (F.col("score").desc(), F.col("vec_id"))
    for keys in (("query_id", "part"), ("query_id",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        partial = partial.withColumn("rank", place).where(F.col("rank") <= k)
    return partial.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
