"""Lenient conversions for landed documents, and the chunking of a range of days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_KINDS = ("year", "month", "range")


def safe_int(value: Column) -> Column:
    """A whole number, or null for anything that is not one."""
    return F.trim(value).try_cast("bigint")


def text_or(value: Column, default: str) -> Column:
    """The text, or ``default`` when it is missing or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def chunks(start: Column, end: Column, kind: str) -> Column:
    """Array of (chunk_start, chunk_end) that covers [start, end], cut at year or month ends."""
    if kind not in CHUNK_KINDS:
        raise ValueError(f"unknown chunk kind {kind!r}; choices: {CHUNK_KINDS}")

    def piece(first: Column, last: Column) -> Column:
        return F.struct(first.alias("chunk_start"), last.alias("chunk_end"))

    if kind == "range":
        return F.array(piece(start, end))
    if kind == "year":
        months = F.make_ym_interval(F.lit(1), F.lit(0))
    else:
        months = F.make_ym_interval(F.lit(0), F.lit(1))
    # Swapping the ends keeps sequence() legal for an empty range, which the filter then empties.
    opening = F.sequence(F.trunc(F.least(start, end), kind), end, months)
    cut = F.transform(
        opening,
        lambda first: piece(
            F.greatest(first, start),
            F.least(F.date_sub((first + months).cast("date"), 1), end),
        ),
    )
    return F.filter(cut, lambda c: c["chunk_start"] <= c["chunk_end"])
