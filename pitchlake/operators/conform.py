"""Fit a frame with drifting columns to a documented table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pitchlake.catalog.columns import SPARK_TYPES, TableLayout
from pitchlake.catalog.columns import Column as TableColumn


@dataclass(frozen=True)
class Drift:
    """Columns a frame has beyond the table, and columns it lacks."""

    unknown: tuple[str, ...]
    missing: tuple[str, ...]


def drift(frame: DataFrame, layout: TableLayout) -> Drift:
    have, want = frame.columns, layout.names
    return Drift(
        unknown=tuple(c for c in have if c not in want),
        missing=tuple(c for c in want if c not in have),
    )


def _converted(source: T.DataType, column: TableColumn) -> str:
    """The column as the table wants it, as SQL text: a wide table is one object per column."""
    name = "`" + column.name.replace("`", "``") + "`"
    value = name
    if isinstance(source, (T.DoubleType, T.FloatType)):
        # Frames that came through pandas write a missing number as NaN.
        value = f"if(isnan({name}), NULL, {name})"
    cast = "CAST"
    if isinstance(source, T.StringType) and column.dtype not in ("string", "array<string>"):
        value, cast = f"nullif(trim({name}), '')", "try_cast"
        if column.dtype == "bigint":
            # A nullable whole number is often landed as "6.0"; a fraction is not cut but null.
            decimal = f"try_cast({value} AS DECIMAL(38, 10))"
            value = (
                f"coalesce(try_cast({value} AS BIGINT),"
                f" if({decimal} = floor({decimal}), try_cast({decimal} AS BIGINT), NULL))"
            )
    elif column.dtype == "bigint" and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
        value, cast = f"if({value} = floor({name}), {value}, NULL)", "try_cast"
    if value == name and source == SPARK_TYPES[column.dtype]:
        return name
    return f"{cast}({value} AS {column.dtype}) AS {name}"


def lost_values(frame: DataFrame, layout: TableLayout) -> DataFrame:
    """Rows (column_name, lost): values that are there in the frame and null in the table.

    These are fractions and numbers beyond a long where a whole number belongs, and texts that are no
    value of the column's type; empty texts and NaN stand for no value. One pass over the frame.
    """
    sources = {f.name: f.dataType for f in frame.schema.fields}
    inexact = (T.StringType, T.DoubleType, T.FloatType, T.DecimalType)
    counted = []
    for c in layout.columns:
        source = sources.get(c.name)
        if not isinstance(source, inexact) or (made := _converted(source, c)) == f"`{c.name}`":
            continue
        name = "`" + c.name.replace("`", "``") + "`"
        there = f"nullif(trim({name}), '') IS NOT NULL" if isinstance(source, T.StringType) else (
            f"{name} IS NOT NULL" + ("" if isinstance(source, T.DecimalType) else f" AND NOT isnan({name})")
        )
        value = made.removesuffix(f" AS {name}")
        counted.append((c.name, f"count_if({there} AND {value} IS NULL)"))
    if not counted:
        return frame.sparkSession.createDataFrame([], "column_name string, lost bigint")
    cells = ", ".join(f"'{name}', c{i}" for i, (name, _) in enumerate(counted))
    return frame.selectExpr(*[f"{n} AS c{i}" for i, (_, n) in enumerate(counted)]).selectExpr(
        f"stack({len(counted)}, {cells}) AS (column_name, lost)"
    )


def fractions(frame: DataFrame, layout: TableLayout) -> DataFrame:
    """Rows (column_name, lost): values landed for a whole number that have a fraction.

    ``conform`` makes them null. One pass over the frame.
    """
    sources = {f.name: f.dataType for f in frame.schema.fields}
    inexact = (T.StringType, T.DoubleType, T.FloatType, T.DecimalType)
    names = [
        c.name for c in layout.columns
        if c.dtype == "bigint" and isinstance(sources.get(c.name), inexact)
    ]
    if not names:
        return frame.sparkSession.createDataFrame([], "column_name string, lost bigint")
    counts = []
    for i, name in enumerate(names):
        value = f"try_cast(nullif(trim(CAST(`{name}` AS STRING)), '') AS DECIMAL(38, 10))"
        counts.append(f"count_if({value} <> floor({value})) AS c{i}")
    cells = ", ".join(f"'{name}', c{i}" for i, name in enumerate(names))
    return frame.selectExpr(*counts).selectExpr(
        f"stack({len(names)}, {cells}) AS (column_name, lost)"
    )


def conform(frame: DataFrame, layout: TableLayout) -> DataFrame:
    """Exactly the layout's columns, in order and type.

    Unknown columns are left out (see ``drift`` for which) and missing ones become typed nulls. So do
    numbers with a fraction or beyond a long where a whole one belongs, and texts that are no value of
    the column's type: one bad value never stops a load (see ``lost_values`` for how many there are).
    """
    sources = {f.name: f.dataType for f in frame.schema.fields}
    return frame.selectExpr(*[
        _converted(sources[c.name], c)
        if c.name in sources
        else f"CAST(NULL AS {c.dtype}) AS `{c.name}`"
        for c in layout.columns
    ])
