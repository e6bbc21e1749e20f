"""The data dictionary: one row per documented column."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import __version__
from pitchlake.catalog.columns import TableLayout
from pitchlake.catalog.support import DICTIONARY
from pitchlake.operators.quality import profile
from pitchlake.operators.tables import TableName, replace_key
from pitchlake.operators.versions import VersionedTable


def dictionary_rows(
    spark: SparkSession,
    layout: TableLayout,
    dataset: str,
    table: str,
    owner: str = "data-eng",
    source_system: str = "pitch_feed",
    now: datetime | None = None,
) -> DataFrame:
    rows = [
        (
            dataset, table, c.name, c.dtype, c.description, c.definition, owner, list(c.tags),
            source_system,
            json.dumps({"library": "pitchlake", "version": __version__, "source_field": c.name}),
        )
        for c in layout.columns
    ]
    fields = ", ".join(f"`{c.name}` {c.dtype}" for c in DICTIONARY.columns[:10])
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return (
        spark.createDataFrame(rows, fields)
        .withColumn("created_at", stamp)
        .withColumn("updated_at", stamp)
        .select(*DICTIONARY.names)
    )


def apply_dictionary(
    spark: SparkSession, name: TableName | VersionedTable, layout: TableLayout, dataset: str, table: str,
    **options,
) -> int:
    """Replace the rows of one table in the dictionary; returns how many there are now.

    In a ``VersionedTable`` readers see the old rows or the new ones, never a part.
    """
    rows = dictionary_rows(spark, layout, dataset, table, **options)
    if isinstance(name, VersionedTable):
        return name.replace_key(rows, dataset=dataset, table=table)
    return replace_key(rows, name, DICTIONARY, dataset=dataset, table=table)


def documented_profile(frame: DataFrame, layout: TableLayout, dataset: str, table: str) -> DataFrame:
    """The profile of a table next to its dictionary entries."""
    entries = dictionary_rows(frame.sparkSession, layout, dataset, table).select(
        F.col("column").alias("column_name"), "description", "tags"
    )
    return profile(frame, layout).join(F.broadcast(entries), "column_name")
