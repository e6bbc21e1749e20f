"""Checks and profiles driven by the column catalogue, each one pass over the table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.catalog.columns import Column as TableColumn
from pitchlake.catalog.columns import TableLayout
from pitchlake.session import compiled_rows

CHECKS = ("not_null", "valid_range", "valid_values", "deprecated")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _violation(column: TableColumn, check: str, year: str) -> str | None:
    """The rule as SQL text: wide tables have hundreds, and text is one object each."""
    value = _quoted(column.name)
    if check == "not_null" and column.required:
        return f"{value} IS NULL"
    if check == "valid_range" and column.low is not None:
        # Bounds in the column's own type, so no value is converted to be compared.
        whole = column.dtype == "bigint"
        low, high = (f"{b:.0f}L" if whole else f"{b}D" for b in (column.low, column.high))
        return f"{value} NOT BETWEEN {low} AND {high}"
    if check == "valid_values" and column.allowed:
        allowed = ", ".join(repr(v) for v in column.allowed)
        return f"{value} NOT IN ({allowed})"
    if check == "deprecated" and column.deprecated:
        return f"{value} IS NOT NULL AND {_quoted(year)} > {column.deprecated}"
    return None


def check_columns(
    frame: DataFrame,
    layout: TableLayout,
    checks: Iterable[str] = CHECKS,
    year: str = "game_year",
) -> DataFrame:
    """Rows (check_name, column_name, violations) for every documented rule.

    Nulls pass the range and value checks. All rules are evaluated in one aggregation.
    """
    checks = list(checks)
    unknown = set(checks) - set(CHECKS)
    if unknown:
        raise ValueError(f"unknown checks {sorted(unknown)}; choices: {CHECKS}")
    rules = [
        (check, column.name, violated)
        for check in checks
        for column in layout.columns
        if column.name in frame.columns
        and (violated := _violation(column, check, year)) is not None
    ]
    if not rules:
        return frame.sparkSession.createDataFrame(
            [], "check_name string, column_name string, violations bigint"
        )
    counted = frame.agg(*[
        F.expr(f"count_if({rule}) AS c{i}") for i, (_, _, rule) in enumerate(rules)
    ])
    cells = ", ".join(f"'{check}', '{name}', c{i}" for i, (check, name, _) in enumerate(rules))
    return counted.selectExpr(
        f"stack({len(rules)}, {cells}) AS (check_name, column_name, violations)"
    )


def duplicates(frame: DataFrame, layout: TableLayout) -> DataFrame:
    """Keys that occur more than once, with how often. Copies are counted before the shuffle."""
    return (
        frame.groupBy(*layout.key)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .orderBy(*layout.key)
    )


def profile(frame: DataFrame, layout: TableLayout) -> DataFrame:
    """Rows (column_name, dtype, row_count, non_null, null_share, min_value, max_value).

    Two passes: text, whose bounds need sorting aggregates, and everything else. Arrays have counts
    but no bounds. The table is read at once, with ``compiled_rows``, and the result is one row a column.
    """
    here = [c for c in layout.columns if c.name in frame.columns]
    texts = [c for c in here if c.dtype == "string"]
    others = [c for c in here if c.dtype != "string"]
    groups = [g for g in (texts, others) if g]

    def measured(columns: list[TableColumn]) -> DataFrame:
        measures = ["count(1) AS n"]
        for i, c in enumerate(columns):
            value = _quoted(c.name)
            bound = "CAST(NULL AS STRING)" if "array" in c.dtype else value
            measures += [f"count({value}) AS c{i}", f"min({bound}) AS l{i}", f"max({bound}) AS h{i}"]
        cells = ", ".join(
            f"'{c.name}', '{c.dtype}', n, c{i}, try_divide(n - c{i}, n),"
            f" CAST(l{i} AS STRING), CAST(h{i} AS STRING)"
            for i, c in enumerate(columns)
        )
        return frame.agg(*[F.expr(m) for m in measures]).selectExpr(
            f"stack({len(columns)}, {cells}) AS (column_name, dtype, row_count, non_null,"
            " null_share, min_value, max_value)"
        )

    found = reduce(DataFrame.union, [measured(g) for g in groups])
    with compiled_rows(frame.sparkSession):
        rows = found.collect()
    return frame.sparkSession.createDataFrame(rows, found.schema)


def games_without_pitches(
    games: DataFrame, pitches: DataFrame, game_types: Iterable[str] = ("R",)
) -> DataFrame:
    """Finished games of the loaded kinds that have no pitch."""
    loaded = pitches.select("game_pk").distinct()
    wanted = (F.col("status_code") == "F") & F.col("game_type").isin(*game_types)
    return (
        games.where(wanted)
        .join(loaded, "game_pk", "left_anti")
        .select("game_pk", "game_date", "game_type")
        .orderBy("game_pk")
    )


def games_without_plate_umpire(pitches: DataFrame, umpires: DataFrame) -> DataFrame:
    """Games with pitches but nobody behind the plate."""
    plate = umpires.where(F.col("position") == "HP").select("game_pk")
    return (
        pitches.select("game_pk", "game_date").distinct()
        .join(plate, "game_pk", "left_anti")
        .orderBy("game_pk")
    )
