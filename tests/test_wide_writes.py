"""Wide rows are made by compiled code, a day is gathered by itself, and what lies in many spans is read once."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks import registry
from pitchlake.catalog.pitches import PITCHES
from pitchlake.operators import colocate, quality, tables
from pitchlake.operators.tables import TableName, create_table, laid_out, replace_days, replace_seasons, replace_spans
from pitchlake.operators.versions import VersionedTable, days, values
from pitchlake.plans import feed
from pitchlake.session import HUGE_METHOD, compiled_rows
from pitchlake.sources import manifest
from tests.helpers import pitches

LIMIT = "spark.sql.codegen.hugeMethodLimit"
FIRST = date(2024, 4, 1)


@pytest.fixture
def setting(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def limits(spark, monkeypatch):
    """The limits that held while something was written or measured."""
    seen = []

    @contextmanager
    def noted(session):
        with compiled_rows(session):
            seen.append(int(session.conf.get(LIMIT)))
            yield

    for module in (tables, quality):
        monkeypatch.setattr(module, "compiled_rows", noted)
    return seen


def spread(spark, count, n):
    """``n`` pitches in eight tasks, over ``count`` days, with texts that do not compress."""
    frame = spark.range(n, numPartitions=8).selectExpr(
        f"date_add(DATE '2024-04-01', CAST(id % {count} AS INT)) AS game_date", "id % 40 AS game_pk", "2024L AS game_year",
        "'R' AS game_type", "sha2(CAST(id AS STRING), 256) AS sv_id", "id AS batter",
    )
    return frame


def test_the_limit_is_set_while_somebody_writes(spark, setting):
    before = spark.conf.get(LIMIT)
    with compiled_rows(spark):
        with compiled_rows(spark):
            assert int(spark.conf.get(LIMIT)) == HUGE_METHOD
        assert int(spark.conf.get(LIMIT)) == HUGE_METHOD
    assert spark.conf.get(LIMIT) == before
    setting(LIMIT, "5000")
    with pytest.raises(OSError), compiled_rows(spark):
        assert spark.conf.get(LIMIT) == "5000"
        raise OSError
    assert spark.conf.get(LIMIT) == "5000"


def test_tables_and_profiles_use_it(spark, table, limits):
    create_table(spark, table, PITCHES)
    replace_days(pitches(spark, {"game_date": FIRST}), table, PITCHES, FIRST, FIRST)
    assert limits == [HUGE_METHOD]
    quality.profile(spark.table(str(table)), PITCHES).collect()
    assert limits == [HUGE_METHOD] * 2


def test_a_day_is_split_only_when_it_is_too_big_itself(spark, table, setting, rows):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    create_table(spark, table, PITCHES)
    frame = spread(spark, 60, 60_000)
    assert replace_days(frame, table, PITCHES, FIRST, FIRST + timedelta(59)) == 60_000
    assert len(spark.table(str(table)).inputFiles()) <= 90
    kept = ["game_date", "game_pk", "sv_id", "batter"]
    assert rows(spark.table(str(table)).select(kept)) == rows(frame.select(kept))


def test_a_bucket_of_a_season_is_split_only_when_it_is_too_big_itself(spark, table, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    layout = colocate.pitches_by_game(8)
    create_table(spark, table, layout)
    frame = spread(spark, 60, 60_000).withColumn("game_year", 2021 + F.col("batter") % 6)
    assert replace_seasons(frame, table, layout, range(2021, 2027)) == 60_000
    assert len(spark.table(str(table)).inputFiles()) <= 72
    assert spark.table(str(table)).count() == 60_000


def test_parts_of_a_slice():
    assert days("game_date", FIRST, FIRST + timedelta(9)).parts() == 10
    assert values(dataset=["a"], table=["x", "y"]).parts() == 2


def test_versions_gather_days_too(spark, tmp_path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    kept = VersionedTable(str(tmp_path / "t"), PITCHES)
    assert kept.replace_days(spread(spark, 60, 60_000), FIRST, FIRST + timedelta(59)) == 60_000
    assert len(kept.read(spark).inputFiles()) <= 90


def test_z_order_is_worked_out_once_a_row(spark):
    frame = pitches(spark, *[{"game_date": FIRST, "game_pk": i} for i in range(9)])
    sorted_rows, _ = laid_out(frame, PITCHES, F.col("game_date") == F.lit(FIRST), "t", ("away_team", "game_pk"))
    plan = sorted_rows._jdf.queryExecution().optimizedPlan().toString()
    orders = [line for line in plan.splitlines() if "Sort [" in line]
    assert orders and not any("transform(" in line for line in orders)
    assert sorted_rows.columns == PITCHES.names


def test_spans_are_left_or_emptied_by_themselves(spark, table):
    create_table(spark, table, PITCHES)
    on = [FIRST + timedelta(i) for i in range(5)]
    replace_days(pitches(spark, *[{"game_date": d} for d in on]), table, PITCHES, on[0], on[-1])

    def left():
        return sorted(r[0] for r in spark.table(str(table)).select("game_date").collect())

    some = pitches(spark, {"game_date": on[0]}, {"game_date": on[0]})
    assert replace_spans(some, table, PITCHES, [(on[0], on[1]), (on[3], on[3])]) == 2
    assert left() == [on[0], on[0], on[2], on[3], on[4]]
    replace_spans(some, table, PITCHES, [(on[0], on[1]), (on[3], on[3])], keep_when_empty=False)
    assert left() == [on[0], on[0], on[2], on[4]]
    assert replace_spans(some, table, PITCHES, []) == 0
    with pytest.raises(Exception, match="outside the slice"):
        replace_spans(some, table, PITCHES, [(on[1], on[1]), (on[3], on[3])])


@pytest.mark.parametrize("own", [False, True])
def test_a_batch_of_many_spans_opens_the_landing_once(spark, table, tmp_path, monkeypatch, rows, own):
    opened, landing = [], str(tmp_path / "landing")
    read = manifest.read_spans
    monkeypatch.setattr(manifest, "read_spans", lambda *a: opened.append(a[2]) or read(*a))
    on = [FIRST + timedelta(2 * i) for i in range(4)]
    frame = pitches(spark, *[{"game_date": d, "game_pk": i} for i, d in enumerate(on)])
    frame.coalesce(1).write.parquet(landing)
    replace = (lambda rows, a, b: replace_days(rows, table, PITCHES, a, b)) if own else None
    files = TableName(table.catalog, table.database, "files")
    assert feed.load_new_files(spark, landing, table, files, str(tmp_path / "place"), replace) == [(d, d) for d in on]
    assert opened == [[(d, d) for d in on]]
    assert rows(spark.table(str(table)).select("game_date", "game_pk")) == [(d, i) for i, d in enumerate(on)]
    listed = spark.sql(f"SHOW TABLES IN {table.catalog}.{table.database}").collect()
    assert not [r for r in listed if r["tableName"].startswith("_batch_")]


def test_landed_months_are_not_sorted(spark, tmp_path):
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    frame = spread(spark, 90, 900).withColumn("month", F.date_format("game_date", "yyyy-MM"))
    with registry._landing_months(spark):
        assert int(spark.conf.get(setting)) >= 12
        frame.write.partitionBy("month").parquet(str(tmp_path / "landing"))
    assert spark.conf.get(setting) == before
    assert spark.read.parquet(str(tmp_path / "landing")).count() == 900
