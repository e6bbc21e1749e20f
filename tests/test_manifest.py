"""The table of landed files: only new ones are looked into, and a range opens only files that overlap it."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import functions as F

from pitchlake.catalog.pitches import PITCHES
from pitchlake.sources import manifest
from pitchlake.sources.pitches import pitch_batch
from tests.helpers import pitches

SPRING = (date(2024, 4, 1), date(2024, 6, 30))


def land(spark, folder, *days, **columns):
    """One file with a pitch for each day."""
    rows = pitches(spark, *[{"game_pk": i, "game_date": d} for i, d in enumerate(days)]).select(
        "game_pk", "game_date", "game_type", "game_year", "at_bat_number", "pitch_number", "batter"
    )
    for name, value in columns.items():
        rows = rows.withColumn(name, value)
    rows.coalesce(1).write.parquet(str(folder))


def names(frame):
    return sorted(f.split("/")[-2] for f in frame.inputFiles())


def test_a_range_opens_the_files_that_overlap_it(spark, table, tmp_path):
    land(spark, tmp_path / "a", date(2024, 4, 1), date(2024, 4, 9))
    land(spark, tmp_path / "b", date(2024, 4, 20), date(2024, 5, 2))
    assert manifest.extend(spark, str(tmp_path), table) == 2
    assert manifest.extend(spark, str(tmp_path), table) == 0
    # A later batch with a new column, and one whose numbers landed as text.
    land(spark, tmp_path / "c +ü", date(2024, 5, 1), date(2024, 5, 30), bat_speed=F.lit(71.5), batter=F.lit("8.0"))
    assert manifest.extend(spark, str(tmp_path), table) == 1
    held = {r.path.split("/")[-2]: r for r in spark.table(str(table)).collect()}
    assert len(held) == 3 and sum(r.rows for r in held.values()) == 6
    assert (held["b"].first_day, held["b"].last_day) == (date(2024, 4, 20), date(2024, 5, 2))
    assert {k: "bat_speed" in r.schema for k, r in held.items() if k in "ab"} == {"a": False, "b": False}
    early = manifest.read_range(spark, table, date(2024, 4, 2), date(2024, 4, 19))
    assert names(early) == ["a"] and [r.game_date for r in early.collect()] == [date(2024, 4, 9)]
    may = manifest.read_range(spark, table, date(2024, 5, 1), date(2024, 5, 31))
    assert len(names(may)) == 2 and may.columns == PITCHES.names
    assert sorted((r.game_date.day, r.batter, r.bat_speed) for r in may.collect()) == [(1, 8, 71.5), (2, 10, None), (30, 8, 71.5)]
    nothing = manifest.read_range(spark, table, date(2025, 1, 1), date(2025, 1, 2))
    assert nothing.count() == 0 and nothing.columns == PITCHES.names


def test_only_new_files_are_read(spark, table, tmp_path):
    """An older file that has become unreadable is not noticed: nothing of it is opened again."""
    land(spark, tmp_path / "a", date(2024, 4, 1))
    manifest.extend(spark, str(tmp_path), table)
    (old,) = (tmp_path / "a").glob("*.parquet")
    stat, size = old.stat(), old.stat().st_size
    old.write_bytes(b"x" * size)
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    for crc in (tmp_path / "a").glob(".*.crc"):
        crc.unlink()
    land(spark, tmp_path / "b", date(2024, 4, 20))
    assert manifest.extend(spark, str(tmp_path), table) == 1
    assert manifest.read_range(spark, table, date(2024, 4, 2), date(2024, 4, 30)).count() == 1


def test_a_file_written_again_and_files_without_days(spark, table, tmp_path):
    land(spark, tmp_path / "a", date(2024, 4, 1))
    land(spark, tmp_path / "none", date(2024, 4, 1), game_date=F.lit(None).cast("date"))
    land(spark, tmp_path / "empty")
    assert manifest.extend(spark, str(tmp_path), table) == 3
    (old,) = (tmp_path / "a").glob("*.parquet")
    land(spark, tmp_path / "b", date(2024, 5, 1), date(2024, 5, 2))
    (new,) = (tmp_path / "b").glob("*.parquet")
    for crc in (*(tmp_path / "a").glob(".*.crc"), *(tmp_path / "b").glob(".*.crc")):
        crc.unlink()
    old.write_bytes(new.read_bytes())
    assert manifest.extend(spark, str(tmp_path), table) == 2
    found = manifest.read_range(spark, table, *SPRING)
    assert names(found) == ["a", "b"] and found.count() == 4
    assert manifest.current(spark.table(str(table))).count() == 4
    landed = spark.read.option("mergeSchema", True).parquet(*[f"{tmp_path}/{n}" for n in ("a", "b", "none", "empty")])
    assert pitch_batch(landed, *SPRING).count() == found.count()
