"""Catalog tables that are replaced slice by slice.

A slice is a set of whole partitions: a range of days, a set of seasons, or one (dataset, table)
pair. The new rows overwrite their partitions in one job, then partitions of the slice that got
no rows are dropped. Running a load twice gives the same table, and after a crash between the two
steps running it again finishes the work.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitchlake.catalog.columns import TableLayout
from pitchlake.operators.cluster import z_value
from pitchlake.operators.conform import conform
from pitchlake.session import compiled_rows


@dataclass(frozen=True)
class TableName:
    """A three-part table name: catalog, database, table."""

    catalog: str
    database: str
    table: str

    @classmethod
    def parse(cls, text: str) -> TableName:
        parts = text.split(".")
        if len(parts) != 3 or not all(parts):
            raise ValueError(f"expected catalog.database.table, got {text!r}")
        return cls(*parts)

    def sibling(self, table: str) -> TableName:
        return TableName(self.catalog, self.database, table)

    def __str__(self) -> str:
        return f"{self.catalog}.{self.database}.{self.table}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def file_options(layout: TableLayout) -> dict[str, str]:
    """Options of the table's Parquet files.

    A file holds the Bloom filter of a column only where its dictionary does not list all values, as
    readers skip row groups by a whole dictionary in the same way.
    """
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in layout.lookup_by}


def create_table(
    spark: SparkSession, name: TableName, layout: TableLayout, location: str | None = None
) -> bool:
    """Create the table with its comments and partitions; False when it is already there."""
    if spark.catalog.tableExists(str(name)):
        return False
    columns = ", ".join(
        f"`{c.name}` {c.dtype} COMMENT {_quoted(c.description)}" for c in layout.columns
    )
    split = ", ".join(f"`{c}`" for c in layout.partition_by)
    options = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in file_options(layout).items())
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet"
        + (f" OPTIONS ({options})" if options else "")
        + (f" PARTITIONED BY ({split})" if split else "")
        + (f" CLUSTERED BY (`{layout.buckets[0]}`) INTO {layout.buckets[1]} BUCKETS" if layout.buckets else "")
        + (f" LOCATION {_quoted(location)}" if location else "")
        + f" COMMENT {_quoted(layout.comment)}"
    )
    return True


def apply_comments(spark: SparkSession, name: TableName, layout: TableLayout) -> int:
    """Set the documented comments on an existing table; returns how many columns changed."""
    current = {f.name: f.metadata.get("comment") for f in spark.table(str(name)).schema.fields}
    changed = [
        c for c in layout.columns if c.name in current and current[c.name] != c.description
    ]
    for c in changed:
        spark.sql(
            f"ALTER TABLE {name} ALTER COLUMN `{c.name}` COMMENT {_quoted(c.description)}"
        )
    return len(changed)


def partitions(spark: SparkSession, name: TableName) -> list[dict[str, str]]:
    """Partition values of the table, as text; a listing of the catalog, not of the data."""
    listed = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [
        {k: unquote(v) for k, v in (part.split("=", 1) for part in row[0].split("/"))}
        for row in listed
    ]


MOST_TASKS = 4000  # before small ones are merged


# The overwrite mode is a setting of the session, which the threads of a driver share.
_OVERWRITE = threading.RLock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only partitions that get rows. Catalog inserts take this from the session only."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    with _OVERWRITE:
        before = spark.conf.get(setting, None)
        spark.conf.set(setting, "dynamic")
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(setting)
            else:
                spark.conf.set(setting, before)


def laid_out(
    frame: DataFrame, layout: TableLayout, inside: Column, where: object, z_order: Sequence[str] = (), parts: int = 0
) -> tuple[DataFrame, Observation]:
    """The rows as they are written, and an observation of (rows, partitions) of that write.

    Inside a partition rows are sorted by the layout's clustering columns or, if ``z_order`` names
    columns, by their Z-order value, whose bounds take one more pass over the frame. ``parts`` is about how
    many partitions the slice has, where that is known.
    """
    rows = conform(frame, layout)
    place = z_value(rows, z_order) if z_order else None
    # A row outside the slice would overwrite a partition the caller did not ask for: stop instead.
    first = layout.partition_by[0]
    rows = rows.withColumn(
        first,
        F.when(inside, F.col(first)).otherwise(
            F.raise_error(F.lit(f"row outside the slice being replaced in {where}")).cast(
                rows.schema[first].dataType
            )
        ),
    )
    # Rebalance gathers a partition's rows into few files, and splits a partition that is too big
    # for one task; the sort then makes row-group statistics useful for the clustering columns.
    # Of a bucketed table, a bucket's rows of a partition are gathered; one that is too big has several files.
    # A task that is split writes a file for each partition it holds, so at first there are as many tasks as
    # partitions, and only a partition that is too big by itself has several files.
    keys, expected = [F.col(c) for c in layout.partition_by], parts
    if layout.buckets:
        key, count = layout.buckets
        keys, expected = [*keys, F.col("_bucket")], max(parts, 1) * count
        rows = rows.withColumn("_bucket", F.pmod(F.hash(key), F.lit(count)))
    first_tasks = max(min(2 * expected, MOST_TASKS), int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.hint("rebalance", *([first_tasks] if expected > 1 else []), *keys).drop("_bucket")
    # Counted while writing, after the shuffle. The set holds partition values, not rows: at most
    # one entry per partition of the slice.
    seen = Observation()
    landed = F.struct(*[F.col(c).cast("string").alias(c) for c in layout.partition_by])
    rows = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(landed).alias("partitions")
    )
    if place is None:
        return rows.sortWithinPartitions(*layout.partition_by, *layout.cluster_by), seen
    # Worked out once a row: as an order it would be worked out anew at every comparison.
    return rows.withColumn("_place", place).sortWithinPartitions(*layout.partition_by, "_place").drop("_place"), seen


def _replace(
    frame: DataFrame,
    name: TableName,
    layout: TableLayout,
    inside: Column,
    covers: Sequence[Callable[[dict[str, str]], bool]],
    drop_when_empty: bool,
    z_order: Sequence[str] = (),
    parts: int = 0,
) -> int:
    """``covers`` tells the partitions of each part of the slice that is emptied, or left, by itself."""
    spark = frame.sparkSession
    rows, seen = laid_out(frame, layout, inside, name, z_order, parts)
    with compiled_rows(spark), _dynamic_overwrite(spark):
        rows.select(*spark.table(str(name)).columns).write.mode("overwrite").insertInto(
            str(name)
        )
    found = seen.get
    count = found.get("rows") or 0
    if count == 0 and not drop_when_empty:
        return 0
    filled = {tuple(p) for p in found.get("partitions") or []}
    landed = [dict(zip(layout.partition_by, p, strict=True)) for p in filled]
    emptied = [c for c in covers if drop_when_empty or any(c(p) for p in landed)]
    stale = [
        p
        for p in partitions(spark, name)
        if any(c(p) for c in emptied) and tuple(p[c] for c in layout.partition_by) not in filled
    ]
    specs = [
        "PARTITION (" + ", ".join(f"`{c}` = {_quoted(p[c])}" for c in layout.partition_by) + ")"
        for p in stale
    ]
    if specs:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(specs)}")
    return count


def replace_days(
    frame: DataFrame, name: TableName, layout: TableLayout, start: date, end: date,
    z_order: Sequence[str] = (), keep_when_empty: bool = True,
) -> int:
    """Make ``frame`` the content of the days [start, end]; returns the rows written.

    An empty frame leaves the table as it is, unless ``keep_when_empty`` is off: then it empties the
    days. ``z_order`` names columns to cluster by in place of the layout's.
    """
    return replace_spans(frame, name, layout, [(start, end)], z_order, keep_when_empty)


def replace_spans(
    frame: DataFrame, name: TableName, layout: TableLayout, spans: Sequence[tuple[date, date]],
    z_order: Sequence[str] = (), keep_when_empty: bool = True,
) -> int:
    """``replace_days`` of several spans [start, end] at once, in one write; returns the rows written.

    Unless ``keep_when_empty`` is off, a span that the frame has no row of is left as it is.
    """
    if not spans:
        return 0
    day = layout.partition_by[0]

    def covers(first: date, last: date) -> Callable[[dict[str, str]], bool]:
        return lambda p: first.isoformat() <= p[day] <= last.isoformat()

    return _replace(
        frame,
        name,
        layout,
        reduce(Column.__or__, [F.col(day).between(F.lit(a), F.lit(b)) for a, b in spans]),
        [covers(a, b) for a, b in spans],
        drop_when_empty=not keep_when_empty,
        z_order=z_order,
        parts=sum((b - a).days + 1 for a, b in spans),
    )


def replace_seasons(
    frame: DataFrame, name: TableName, layout: TableLayout, seasons: Iterable[int]
) -> int:
    """Make ``frame`` the content of the given seasons; returns the rows written.

    An empty frame empties the seasons. No seasons means nothing to do.
    """
    wanted = sorted({int(s) for s in seasons})
    if not wanted:
        return 0
    season = layout.partition_by[0]
    return _replace(
        frame,
        name,
        layout,
        F.col(season).isin(wanted),
        [lambda p: p[season] in {str(s) for s in wanted}],
        drop_when_empty=True,
        parts=len(wanted),
    )


def replace_key(frame: DataFrame, name: TableName, layout: TableLayout, **key: str) -> int:
    """Make ``frame`` the content of the one partition given by ``key``."""
    if set(key) != set(layout.partition_by):
        raise ValueError(f"give a value for each of {list(layout.partition_by)}")
    inside = F.lit(True)
    for column, value in key.items():
        inside = inside & (F.col(f"`{column}`") == value)
    return _replace(
        frame, name, layout, inside, [lambda p: all(p[c] == v for c, v in key.items())], False
    )


def write_report(frame: DataFrame, path: str) -> None:
    """Comparison rows or summaries as JSON lines."""
    frame.write.mode("overwrite").json(path)
