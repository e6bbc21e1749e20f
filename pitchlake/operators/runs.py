"""The run log and what it says about chunks that still have to be loaded."""

from __future__ import annotations

import logging
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import __version__
from pitchlake.catalog.support import RUNS
from pitchlake.functions.parse import chunks
from pitchlake.operators.tables import TableName

log = logging.getLogger(__name__)


def chunk_table(bounds: DataFrame, kind: str, start: str = "start", end: str = "end") -> DataFrame:
    """Rows (chunk_start, chunk_end) for every [start, end] in ``bounds``."""
    return bounds.select(F.inline(chunks(F.col(f"`{start}`"), F.col(f"`{end}`"), kind)))


def range_chunks(spark: SparkSession, start: date, end: date, kind: str) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return chunk_table(bounds, kind)


def completed(runs: DataFrame) -> DataFrame:
    """Chunks that some attempt finished, with rows or without."""
    return (
        runs.where(F.col("status").isin("success", "empty"))
        .select("chunk_start", "chunk_end")
        .distinct()
    )


def completed_chunks(spark: SparkSession, name: TableName) -> DataFrame:
    """``completed`` of the log table; none when there is no log yet."""
    if not spark.catalog.tableExists(str(name)):
        return spark.createDataFrame([], "chunk_start date, chunk_end date")
    return completed(spark.table(str(name)))


def pending(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks without a finished attempt for exactly the same days."""
    return wanted.join(done, ["chunk_start", "chunk_end"], "left_anti")


def record_run(
    spark: SparkSession,
    name: TableName,
    chunk_start: date,
    chunk_end: date,
    kind: str,
    status: str,
    rows_written: int,
    started_at: datetime,
    error: str | None = None,
) -> bool:
    """Append one attempt. A log that cannot be written never fails the load: False instead."""
    allowed = RUNS["status"].allowed
    if status not in allowed:
        raise ValueError(f"unknown status {status!r}; choices: {allowed}")
    values = {
        "chunk_start": chunk_start,
        "chunk_end": chunk_end,
        "chunk_kind": kind,
        "rows_written": rows_written,
        "status": status,
        "started_at": started_at,
        "finished_at": datetime.now(UTC),
        "library_version": __version__,
        "error": error,
    }
    try:
        spark.range(1).select(*[
            F.lit(values[c.name]).cast(c.dtype).alias(c.name) for c in RUNS.columns
        ]).coalesce(1).write.insertInto(str(name))
    except Exception:
        log.exception("run of %s..%s (%s) was not logged", chunk_start, chunk_end, status)
        return False
    return True
