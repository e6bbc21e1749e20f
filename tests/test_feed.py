"""The daily feed gives what one load of everything gives: late days, reruns, a crash inside a batch."""

from __future__ import annotations

from datetime import date

import pytest

from pitchlake.operators.tables import TableName
from pitchlake.plans.feed import load_new_files, spans
from pitchlake.sources.pitches import pitch_batch
from tests.helpers import pitches

YEAR = (date(2024, 1, 1), date(2024, 12, 31))


def land(spark, folder, *rows):
    pitches(spark, *[{"game_date": date(2024, 4, d), "game_pk": g} for d, g in rows]).coalesce(1).write.mode("append").parquet(folder)


def test_spans():
    days = [date(2024, 4, d) for d in (9, 1, 2, 3, 5, 2)]
    assert spans(days) == [(days[1], days[3]), (days[4], days[4]), (days[0], days[0])]
    assert spans([]) == []


def test_feed_equals_one_load(spark, table, tmp_path, rows):
    landing, files = str(tmp_path / "landing"), TableName(table.catalog, table.database, "files")

    def load(**more):
        return load_new_files(spark, landing, table, files, str(tmp_path / "place"), **more)

    def check():
        wanted = pitch_batch(spark.read.parquet(landing), *YEAR).select("game_date", "game_pk")
        assert rows(spark.table(str(table)).select("game_date", "game_pk")) == rows(wanted)

    land(spark, landing, (1, 1), (2, 2), (2, 3))
    assert load() == [(date(2024, 4, 1), date(2024, 4, 2))]
    check()
    assert load() == []
    check()
    # A new day, and a late file for an old one, which adds to that day.
    land(spark, landing, (3, 4))
    land(spark, landing, (1, 5))
    assert sorted(load()) == [(date(2024, 4, 1), date(2024, 4, 1)), (date(2024, 4, 3), date(2024, 4, 3))]
    check()
    # A batch that fails is run again by the next call.
    land(spark, landing, (2, 6), (7, 7))

    def fail(frame, first, last):
        raise OSError("disk on fire")

    with pytest.raises(Exception, match="disk on fire"):
        load(replace=fail)
    assert spark.table(str(table)).count() == 5
    assert sorted(load()) == [(date(2024, 4, 2), date(2024, 4, 2)), (date(2024, 4, 7), date(2024, 4, 7))]
    check()
