"""Tables by game join without a shuffle; Bloom filters let point lookups skip row groups."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pitchlake.catalog.columns import TableLayout
from pitchlake.catalog.games import GAMES, UMPIRES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.operators import colocate, quality
from pitchlake.operators.conform import conform
from pitchlake.operators.tables import create_table, file_options, replace_days, replace_seasons
from pitchlake.plans import games
from tests.helpers import pitches


@pytest.fixture
def setting(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def made(spark, table):
    rng = random.Random(2)
    thrown = pitches(spark, *[
        {"game_pk": rng.randrange(40), "game_year": 2023 + i % 2, "at_bat_number": i, "pitcher": i % 7} for i in range(800)
    ])
    crew = conform(spark.createDataFrame(
        [(g, date(2023 + g % 2, 5, 1), "HP", g % 5, "U") for g in range(0, 40, 3)],
        "game_pk long, game_date date, position string, umpire_id long, umpire_name string",
    ), UMPIRES)
    played = conform(spark.createDataFrame(
        [(g, 2023 + g % 2, date(2023 + g % 2, 5, 1), "R", "F") for g in range(50)],
        "game_pk long, season long, game_date date, game_type string, status_code string",
    ), GAMES)
    out = {}
    for kind, layout, frame in (
        ("pitches", colocate.pitches_by_game(8), thrown), ("games", colocate.games_by_game(8), played),
        ("umpires", colocate.umpires_by_game(8), colocate.with_season(crew)),
    ):
        name = table.sibling(kind)
        create_table(spark, name, layout)
        for _ in range(2):
            replace_seasons(frame, name, layout, [2023, 2024])
        out[kind] = (frame, spark.table(str(name)), layout, name)
    return out


def test_joins_by_game_have_no_exchange(spark, table, rows, setting):
    found = made(spark, table)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    thrown, crew, played = (found[k][1] for k in ("pitches", "umpires", "games"))
    work = games.plate_umpire_workload(thrown, crew)
    missing = quality.games_without_pitches(played, thrown)
    starters = games.announced_and_actual_starters(thrown, played)
    for frame in (work, missing, starters):
        assert "Join" in plan(frame) and "hashpartitioning(game_pk" not in plan(frame)
    assert rows(work) == rows(games.plate_umpire_workload(found["pitches"][0], found["umpires"][0]))
    assert rows(missing) == rows(quality.games_without_pitches(found["games"][0], found["pitches"][0]))
    assert rows(starters) == rows(games.announced_and_actual_starters(found["pitches"][0], found["games"][0]))
    setting("spark.sql.sources.bucketing.enabled", "false")
    assert "hashpartitioning(game_pk" in plan(games.plate_umpire_workload(thrown, crew))


def test_a_season_is_replaced_by_itself(spark, table, rows):
    frame, _, layout, name = made(spark, table)["pitches"]
    other = pitches(spark, {"game_pk": 900, "game_year": 2024, "at_bat_number": 5})
    assert replace_seasons(other, name, layout, [2024]) == 1
    now = spark.table(str(name))
    assert rows(now.where("game_year = 2024").select("game_pk")) == [(900,)]
    assert now.where("game_year = 2023").count() == frame.where("game_year = 2023").count()


def test_unknown_lookup_and_bucket_columns_are_refused():
    with pytest.raises(ValueError, match="unknown"):
        TableLayout(GAMES.columns, "x", lookup_by=("no",))
    with pytest.raises(ValueError, match="unknown"):
        TableLayout(GAMES.columns, "x", buckets=("no", 4))
    assert file_options(GAMES) == {}


def scanned(spark, name, condition):
    """Rows that the scan gave to the filter, and rows that passed it."""
    frame = spark.table(str(name)).where(condition).select("batter")
    count = len(frame.collect())
    node = frame._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value(), count


def test_point_lookups_skip_row_groups_by_bloom_filter(spark, table, setting):
    rng = random.Random(4)
    frame = pitches(spark, *[
        {"game_date": date(2024, 5, 1), "at_bat_number": i, "batter": rng.randrange(1 << 40), "game_pk": i % 30}
        for i in range(30_000)
    ])
    settings = {
        "parquet.block.size": "65536", "parquet.page.size.row.check.min": "50", "parquet.page.size.row.check.max": "200",
        "parquet.dictionary.page.size": "1024", "parquet.bloom.filter.max.bytes": "8192",
    }
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = {k: conf.get(k) for k in settings}
    create_table(spark, table, PITCHES)
    try:
        for k, v in settings.items():
            conf.set(k, v)
        replace_days(frame.coalesce(1), table, PITCHES, date(2024, 5, 1), date(2024, 5, 1))
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    wanted = frame.orderBy("at_bat_number").first()["batter"]
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.parquet.enableVectorizedReader", "true")
    with_filter = scanned(spark, table, F.col("batter") == wanted)
    setting("parquet.filter.bloom.enabled", "false")
    without = scanned(spark, table, F.col("batter") == wanted)
    assert with_filter[1] == without[1] == 1
    assert with_filter[0] <= without[0] / 5, (with_filter, without)
