"""The daily feed: newly landed files into the pitch table, as a stream that ends when it has caught up.

The stream reads nothing but the day of each new row and keeps which files it has seen. A batch replaces the
days it touches by all that has landed for them, old files and new, which the table of landed files finds
without looking through the landing. So a late file for an old day adds to that day, and a batch that is
run again after a crash gives the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.catalog.pitches import PITCHES
from pitchlake.operators import tables
from pitchlake.operators.tables import TableName, create_table
from pitchlake.sources import manifest

Replace = Callable[[DataFrame, date, date], int]


def spans(days: list[date]) -> list[tuple[date, date]]:
    """Runs of consecutive days."""
    found: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if found and day - found[-1][1] == timedelta(days=1):
            found[-1] = (found[-1][0], day)
        else:
            found.append((day, day))
    return found


@contextmanager
def _gathered(rows: DataFrame, pitches: TableName, found: list[tuple[date, date]]) -> Iterator[DataFrame]:
    """The rows from a table split by day that lasts as long as the batch, beside the pitch table."""
    spark = rows.sparkSession
    name = pitches.sibling(f"_batch_{uuid.uuid4().hex[:12]}")
    try:
        create_table(spark, name, PITCHES)
        tables.replace_spans(rows, name, PITCHES, found)
        yield spark.table(str(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_new_files(
    spark: SparkSession, landing: str, pitches: TableName, files: TableName, checkpoint: str,
    replace: Replace | None = None, files_per_batch: int = 1000,
) -> list[tuple[date, date]]:
    """Load what landed since the last call; returns the spans of days that were replaced.

    ``checkpoint`` keeps the stream's place and ``files`` the table of landed files. ``replace`` writes a
    span of days, by default into the table ``pitches``; give ``states.replace_days`` or a versioned table's
    to keep those. A batch opens each file once, however many spans its days are: without ``replace`` they are
    written together, else a table gathers the batch by day for as long as it takes.
    """
    create_table(spark, pitches, PITCHES)
    done: list[tuple[date, date]] = []

    def batch(rows: DataFrame, _: int) -> None:
        # The days of the new files, a few hundred a season.
        days = [r[0] for r in rows.select("game_date").where("game_date IS NOT NULL").distinct().collect()]
        manifest.extend(spark, landing, files)
        found = spans(days)
        rows = manifest.read_spans(spark, files, found)
        if replace is None:
            tables.replace_spans(rows, pitches, PITCHES, found)
            done.extend(found)
        elif len(found) < 2:
            for first, last in found:
                replace(rows, first, last)
                done.append((first, last))
        else:
            with _gathered(rows, pitches, found) as by_day:
                for first, last in found:
                    replace(by_day.where(F.col("game_date").between(F.lit(first), F.lit(last))), first, last)
                    done.append((first, last))

    stream = (
        spark.readStream.schema("game_date date").option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    )
    query = (
        stream.select(F.col("game_date")).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return done
