"""A table of landed files, so that a landing that grows is not looked through again at every load.

``extend`` lists the landing, takes the files that the table does not know in this state, and reads the day
column of these alone; what it writes is one row a file. ``read_range`` opens only files that hold a day of
the range, with the columns that the table has noted for them, so no footer is read to learn a schema.
Files that landed together share a schema; files that disagree on the type of a column are read apart and
joined as the pitch table wants them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.catalog.support import FILES
from pitchlake.operators.tables import TableName, create_table
from pitchlake.sources.pitches import empty_pitches, pitch_batch, union_batches

DAY = "game_date"


def list_files(spark: SparkSession, landing: str, suffix: str = "*.parquet") -> DataFrame:
    """(path, modified, bytes) of the landing's files; no file is opened."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", suffix).load(landing)
    )
    return found.select(
        "path", F.unix_micros(F.col("modificationTime").cast("timestamp")).alias("modified"),
        F.col("length").alias("bytes"),
    )


def unknown_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files that are not known with the same time and size."""
    return listed.join(known.select("path", "modified", "bytes"), ["path", "modified", "bytes"], "left_anti")


def extend(spark: SparkSession, landing: str, name: TableName, day: str = DAY) -> int:
    """Note the landing's new files in the table ``name``; returns how many there are.

    A file that was written again is noted again; its newest row counts. The new files' footers and
    day columns are read, and nothing of the older ones.
    """
    create_table(spark, name, FILES)
    new = unknown_files(list_files(spark, landing), spark.table(str(name)))
    # A load's new files, as many as it has to read anyway; their names go to the reader.
    paths = [r["path"] for r in new.select("path").orderBy("path").collect()]
    if not paths:
        return 0
    rows = spark.read.option("mergeSchema", True).parquet(*paths)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    days = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.min(F.col(day).cast("date")).alias("first_day"), F.max(F.col(day).cast("date")).alias("last_day"),
        F.count("*").alias("rows"),
    )
    noted = new.join(days, _same_path(new["path"]) == _same_path(days["path"]), "left").select(
        new["path"], "modified", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), "first_day", "last_day",
        F.lit(schema.json()).alias("schema"), F.current_timestamp().alias("noted_at"),
    )
    noted.select(*FILES.names).coalesce(1).write.insertInto(str(name))
    return len(paths)


def _same_path(path: Column) -> Column:
    """A path without its scheme's slashes and escapes: two readers spell local ones differently."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(path, r"\+", "%2B"), "^file:/+", "/"))


def current(files: DataFrame) -> DataFrame:
    """The newest row of each file."""
    line = F.struct(*[c for c in FILES.names if c != "path"])
    place = F.struct("modified", "noted_at")
    return files.groupBy("path").agg(F.max_by(line, place).alias("line")).select("path", "line.*")


def overlapping(files: DataFrame, start: date, end: date) -> DataFrame:
    """Files with a day in [start, end]; those without any day have none."""
    return current(files).where((F.col("first_day") <= F.lit(end)) & (F.col("last_day") >= F.lit(start)))


def read_range(spark: SparkSession, name: TableName, start: date, end: date) -> DataFrame:
    """Pitches of [start, end] from the files that overlap it, with exactly the pitch table's columns."""
    return read_spans(spark, name, [(start, end)])


def read_spans(spark: SparkSession, name: TableName, spans: Sequence[tuple[date, date]]) -> DataFrame:
    """Pitches of several spans [start, end]. A file is opened once, however many of the spans it overlaps."""
    if not spans:
        return empty_pitches(spark)
    start, end = min(a for a, _ in spans), max(b for _, b in spans)
    wanted = overlapping(spark.table(str(name)), start, end).select("schema", "path", "first_day", "last_day")
    by_schema: dict[str, list[str]] = {}
    for r in wanted.orderBy("path").collect():  # names of the files to be opened
        if any(r["first_day"] <= b and a <= r["last_day"] for a, b in spans):
            by_schema.setdefault(r["schema"], []).append(r["path"])
    if not by_schema:
        return empty_pitches(spark)
    inside = reduce(Column.__or__, [F.col(DAY).between(F.lit(a), F.lit(b)) for a, b in spans])
    parts = [
        pitch_batch(spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths), start, end).where(inside)
        for schema, paths in sorted(by_schema.items())
    ]
    return union_batches(parts)
