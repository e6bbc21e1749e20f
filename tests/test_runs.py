from __future__ import annotations

from datetime import UTC, date, datetime

import pytest

from pitchlake.catalog.support import RUNS
from pitchlake.operators.runs import (
    chunk_table,
    completed_chunks,
    pending,
    range_chunks,
    record_run,
)
from pitchlake.operators.tables import create_table

D = date
CASES = [
    ("year", D(2024, 6, 15), D(2026, 3, 10),
     [(D(2024, 6, 15), D(2024, 12, 31)), (D(2025, 1, 1), D(2025, 12, 31)),
      (D(2026, 1, 1), D(2026, 3, 10))]),
    ("month", D(2024, 2, 15), D(2024, 4, 10),
     [(D(2024, 2, 15), D(2024, 2, 29)), (D(2024, 3, 1), D(2024, 3, 31)),
      (D(2024, 4, 1), D(2024, 4, 10))]),
    ("month", D(2025, 1, 15), D(2025, 3, 5),
     [(D(2025, 1, 15), D(2025, 1, 31)), (D(2025, 2, 1), D(2025, 2, 28)),
      (D(2025, 3, 1), D(2025, 3, 5))]),
    ("range", D(2024, 1, 1), D(2026, 1, 1), [(D(2024, 1, 1), D(2026, 1, 1))]),
    ("year", D(2024, 5, 5), D(2024, 5, 5), [(D(2024, 5, 5), D(2024, 5, 5))]),
    ("month", D(2024, 5, 5), D(2024, 5, 1), []),
    ("year", D(2025, 5, 5), D(2024, 5, 1), []),
]


@pytest.mark.parametrize(("kind", "start", "end", "expected"), CASES)
def test_chunks(spark, kind, start, end, expected):
    found = range_chunks(spark, start, end, kind).orderBy("chunk_start").collect()
    assert [tuple(r) for r in found] == expected


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="week"):
        range_chunks(spark, D(2024, 1, 1), D(2024, 1, 2), "week")


def test_chunk_table_takes_many_ranges(spark, rows):
    bounds = spark.createDataFrame(
        [(D(2024, 1, 1), D(2024, 1, 2)), (D(2025, 1, 1), D(2025, 2, 1))], "start date, end date"
    )
    assert len(rows(chunk_table(bounds, "month"))) == 3


def test_pending_needs_the_same_days(spark, table, rows):
    create_table(spark, table, RUNS)
    began = datetime(2024, 1, 1, tzinfo=UTC)
    months = range_chunks(spark, D(2024, 1, 1), D(2024, 4, 30), "month")
    for first, last, status in (
        (D(2024, 1, 1), D(2024, 1, 31), "success"),
        (D(2024, 2, 1), D(2024, 2, 29), "empty"),
        (D(2024, 3, 1), D(2024, 3, 31), "failed"),
        (D(2024, 4, 1), D(2024, 4, 29), "success"),
    ):
        assert record_run(spark, table, first, last, "month", status, 1, began)
    left = rows(pending(months, completed_chunks(spark, table)))
    assert left == [(D(2024, 3, 1), D(2024, 3, 31)), (D(2024, 4, 1), D(2024, 4, 30))]


def test_log_row(spark, table):
    create_table(spark, table, RUNS)
    began = datetime(2024, 1, 1, 12, 0, tzinfo=UTC)
    record_run(spark, table, D(2024, 1, 1), D(2024, 1, 2), "range", "failed", 0, began, "it's bad")
    row = spark.table(str(table)).collect()[0]
    assert (row.status, row.rows_written, row.error) == ("failed", 0, "it's bad")
    assert row.started_at == datetime(2024, 1, 1, 12, 0)
    assert row.finished_at > row.started_at


def test_a_log_that_cannot_be_written_is_not_an_error(spark, table):
    began = datetime(2024, 1, 1, tzinfo=UTC)
    assert not record_run(spark, table, D(2024, 1, 1), D(2024, 1, 2), "range", "empty", 0, began)
    assert completed_chunks(spark, table).count() == 0
    with pytest.raises(ValueError, match="status"):
        record_run(spark, table, D(2024, 1, 1), D(2024, 1, 2), "range", "done", 0, began)
