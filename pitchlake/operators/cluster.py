"""Clustering rows on several columns at once: a Z-order value from quantile ranks.

A linear sort keeps only its first column together. Here each column is cut at its quantiles into
``2^bits`` ranges of about equal row numbers, and the bits of the ranks are interleaved, so that rows near
each other in the order are near in every column, and a filter on any one of them skips row groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6
PREFIX = 7  # bytes of a text that decide its place: what a long holds
ACCURACY = 2000


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _number(field: T.StructField) -> str:
    """The column as a number of the same order (texts: by their first bytes), as SQL text."""
    name = _quoted(field.name)
    if isinstance(field.dataType, T.StringType):
        return f"CAST(conv(rpad(hex(substring(encode({name}, 'UTF-8'), 1, {PREFIX})), {2 * PREFIX}, '0'), 16, 10) AS BIGINT)"
    if isinstance(field.dataType, T.DateType):
        return f"CAST(unix_date({name}) AS BIGINT)"
    if isinstance(field.dataType, T.TimestampType):
        return f"unix_micros({name})"
    if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        return f"CAST({name} AS DOUBLE)"
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return f"CAST({name} AS BIGINT)"
    raise ValueError(f"{field.name}: no order for {field.dataType.simpleString()}")


def quantile_bounds(frame: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """The cuts between ranks of each column, fewer where values repeat; one pass, ``2^bits`` numbers a column."""
    shares = "array(" + ", ".join(f"{i / 2**bits}D" for i in range(1, 2**bits)) + ")"
    numbers = [_number(frame.schema[c]) for c in columns]
    row = frame.agg(*[
        F.expr(f"percentile_approx({n}, {shares}, {ACCURACY})").alias(f"c{i}") for i, n in enumerate(numbers)
    ]).first()
    return {c: sorted(set(row[f"c{i}"] or [])) for i, c in enumerate(columns)}


def _rank(value: str, bounds: list[float]) -> str:
    """How many bounds the value exceeds, by nested halving; a null has rank 0."""
    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"if({value} > {bounds[middle]!r}, {search(middle + 1, high)}, {search(low, middle)})"

    return search(0, len(bounds))


def z_value(frame: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The interleaved ranks of the columns; the first column has the highest bit. Reads the frame once."""
    if not columns or bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns with {bits} bits each do not fit a long")
    bounds = quantile_bounds(frame, columns, bits)
    # A rank is held where it is named first, so that its halvings are not repeated for every bit.
    ranks = "named_struct(" + ", ".join(
        f"'r{i}', CAST({_rank(_number(frame.schema[c]), bounds[c])} AS BIGINT)" for i, c in enumerate(columns)
    ) + ")"
    terms = [
        f"shiftleft(shiftright(r.r{i}, {bit}) & 1L, {bit * len(columns) + len(columns) - 1 - i})"
        for i in range(len(columns)) for bit in range(bits)
    ]
    return F.expr(f"transform(array({ranks}), r -> {' | '.join(terms)})[0]")
