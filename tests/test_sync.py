from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from pitchlake.plans.sync import SyncTables, sync
from pitchlake.sources import documents as docs
from tests.helpers import pitches

SPAN = (date(2024, 4, 15), date(2024, 6, 10))


def parsed(spark, documents, schema):
    text = spark.createDataFrame([(json.dumps(d),) for d in documents], "text string")
    return docs.parse_documents(text, "text", schema)


@pytest.fixture
def landed(spark):
    frame = pitches(
        spark,
        {"game_pk": 1, "game_date": date(2024, 4, 20)}, {"game_pk": 1, "game_date": date(2024, 4, 20)},
        {"game_pk": 2, "game_date": date(2024, 6, 1)}, {"game_pk": 3, "game_date": date(2024, 6, 10)},
        {"game_pk": 4, "game_date": date(2024, 6, 11)},
        {"game_pk": 5, "game_date": date(2024, 5, 1), "game_type": "S"},
    )
    return frame.withColumn("miss_distance", F.lit(0.5))


@pytest.fixture
def boxscores(spark):
    return parsed(spark, [
        {"game_pk": g, "officials": [
            {"official": {"id": 70 + g, "fullName": "U"}, "officialType": "Home Plate"},
        ]} for g in (1, 2, 4)
    ], docs.BOXSCORE)


@pytest.fixture
def schedules(spark):
    def game(pk, season):
        return {"gamePk": pk, "season": season, "officialDate": f"{season}-05-01",
                "teams": {"home": {"team": {"id": 116}}, "away": {"team": {"id": 147}}}}

    return parsed(
        spark, [{"dates": [{"games": [game(1, 2024), game(8, 2023)]}]}], docs.SCHEDULE
    )


def log(spark, where):
    return sorted(
        (r.chunk_start.isoformat(), r.status, r.rows_written)
        for r in spark.table(str(where.runs)).collect()
    )


def test_load_resume_and_repeat(spark, table, landed, boxscores, schedules):
    where = SyncTables.beside(str(table))
    assert str(where.umpires).endswith(".game_umpires")
    options = {"boxscores": boxscores, "schedules": schedules, "chunk_kind": "month"}
    assert len(sync(spark, landed, where, *SPAN, **options)) == 3

    def counts():
        return [spark.table(str(n)).count() for n in (where.pitches, where.umpires, where.games)]

    assert counts() == [4, 2, 1]
    assert log(spark, where) == [
        ("2024-04-15", "success", 2), ("2024-05-01", "empty", 0), ("2024-06-01", "success", 2),
    ]
    assert sync(spark, landed, where, *SPAN, resume=True, **options) == []
    longer = (SPAN[0], date(2024, 6, 11))
    assert sync(spark, landed, where, *longer, resume=True, **options) == [
        (date(2024, 6, 1), date(2024, 6, 11))
    ]
    assert counts() == [5, 3, 1]
    sync(spark, landed, where, *longer, **options)
    assert counts() == [5, 3, 1]


def test_dry_run_writes_nothing(spark, table, landed):
    where = SyncTables.beside(str(table), runs=f"{table.catalog}.{table.database}.log")
    assert sync(spark, landed, where, *SPAN, chunk_kind="year", dry_run=True) == [SPAN]
    assert not spark.catalog.tableExists(str(where.pitches))
    assert where.runs.table == "log"


def test_failures_are_logged_and_raised(spark, table, landed):
    where = SyncTables.beside(str(table))
    broken = landed.withColumn(
        "game_pk", F.when(F.col("game_pk") < 2, F.col("game_pk")).otherwise(
            F.raise_error(F.lit("disk on fire")).cast("bigint"))
    )
    with pytest.raises(Exception, match="disk on fire"):
        sync(spark, broken, where, *SPAN, chunk_kind="month")
    assert log(spark, where)[-1] == ("2024-06-01", "failed", 0)
    assert "disk on fire" in spark.table(str(where.runs)).where("status = 'failed'").collect()[0].error
    assert sync(spark, landed, where, *SPAN, chunk_kind="month", resume=True) == [
        (date(2024, 6, 1), SPAN[1])
    ]


def test_missing_schedules_do_not_empty_the_seasons(spark, table, landed, schedules):
    where = SyncTables.beside(str(table))
    sync(spark, landed, where, *SPAN, schedules=schedules)
    with pytest.raises(ValueError, match="no schedule documents"):
        sync(spark, landed, where, *SPAN, schedules=schedules.where("false"))
    assert spark.table(str(where.games)).count() == 1
    # An empty document of a named season empties that season.
    text = spark.createDataFrame([('{"dates": []}', 2024)], "text string, season int")
    nothing = docs.parse_documents(text, "text", docs.SCHEDULE, ["season"])
    sync(spark, landed, where, *SPAN, schedules=nothing)
    assert spark.table(str(where.games)).count() == 0


def test_a_season_without_documents_stays(spark, table, landed, schedules, caplog):
    where = SyncTables.beside(str(table))
    both = (date(2023, 4, 15), date(2024, 6, 10))
    sync(spark, landed, where, *both, schedules=schedules)
    assert {r.season for r in spark.table(str(where.games)).collect()} == {2023, 2024}
    odd = {"dates": [{"games": [
        {"gamePk": 9, "season": 2023, "teams": {"home": {"team": {"id": 116}}, "away": {"team": {"id": 147}}}},
        {"gamePk": 10, "season": "?", "teams": {"home": {"team": {"id": 116}}, "away": {"team": {"id": 147}}}},
    ]}]}
    sync(spark, landed, where, *both, schedules=parsed(spark, [odd], docs.SCHEDULE))
    assert sorted((r.season, r.game_pk) for r in spark.table(str(where.games)).collect()) == [(2023, 9), (2024, 1)]
    assert "[2024]" in caplog.text and "without a readable season" in caplog.text


def test_box_scores_are_parsed_once(spark, table, landed, boxscores):
    parses = spark.sparkContext.accumulator(0)
    watched = boxscores.mapInPandas(lambda parts: (parses.add(len(p)) or p for p in parts), boxscores.schema)
    where = SyncTables.beside(str(table))
    sync(spark, landed, where, *SPAN, boxscores=watched, chunk_kind="month")
    assert parses.value == 3
    names = [t.name for t in spark.catalog.listTables(f"{table.catalog}.{table.database}")]
    assert not [n for n in names if n.startswith("_officials")]


def season_of(*games):
    def game(pk):
        return {"gamePk": pk, "season": 2024, "officialDate": "2024-05-01",
                "teams": {"home": {"team": {"id": 109}}, "away": {"team": {"id": 120}}}}

    return json.dumps({"dates": [{"games": [game(g) for g in games]}]})


def land(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.json").write_text(text + "\n")


def games_of(spark, where):
    return sorted(r.game_pk for r in spark.table(str(where.games)).collect())


@pytest.mark.parametrize("broken", [season_of(1, 2)[:-40], '{"message": "try again"}', "<html>busy</html>", '{"dates": null}'])
def test_a_damaged_document_replaces_nothing(spark, table, landed, tmp_path, caplog, broken):
    where = SyncTables.beside(str(table))
    land(tmp_path / "season=2024", first=season_of(1, 2))
    read = docs.read_documents(spark, str(tmp_path), docs.SCHEDULE)
    sync(spark, landed, where, *SPAN, schedules=read)
    assert games_of(spark, where) == [1, 2]
    alone = tmp_path / "other"
    land(alone / "season=2024", cut=broken)
    with pytest.raises(ValueError, match="no schedule documents"):
        sync(spark, landed, where, *SPAN, schedules=docs.read_documents(spark, str(alone), docs.SCHEDULE))
    assert games_of(spark, where) == [1, 2] and "put aside" in caplog.text
    # Beside a good document the good one counts.
    land(alone / "season=2024", good=season_of(2, 3))
    sync(spark, landed, where, *SPAN, schedules=docs.read_documents(spark, str(alone), docs.SCHEDULE))
    assert games_of(spark, where) == [2, 3]
    kept = spark.table(str(where.quarantine)).collect()
    assert len(kept) == 2 and {(r.kind, r.season) for r in kept} == {("schedule", 2024)}
    reason = "no answer" if broken.startswith('{"') and broken.endswith("}") else "unreadable"
    assert {r.reason for r in kept} == {reason} and all(r.file.endswith("cut.json") for r in kept)
    assert {r.document for r in kept} == {broken if reason == "unreadable" else None}


def test_damaged_box_scores_leave_the_older_crew(spark, table, landed):
    crew = {"game_pk": 1, "officials": [{"official": {"id": 71, "fullName": "U"}, "officialType": "Home Plate"}]}
    text = spark.createDataFrame(
        [(json.dumps(crew), 1), (json.dumps(crew)[:30], 2), ('{"game_pk": 1}', 3)], "text string, version long"
    )
    where = SyncTables.beside(str(table))
    sync(spark, landed, where, *SPAN, boxscores=docs.parse_documents(text, "text", docs.BOXSCORE, ["version"]))
    assert [r.umpire_id for r in spark.table(str(where.umpires)).collect()] == [71]
    kept = spark.table(str(where.quarantine)).collect()
    assert sorted((r.reason, r.game_pk, r.version) for r in kept) == [("no answer", 1, 3), ("unreadable", None, 2)]


def test_whole_season_documents_drop_games(spark, table, landed, tmp_path):
    where = SyncTables.beside(str(table))
    text = spark.createDataFrame(
        [(season_of(1, 2, 3), 2024, 1), (season_of(3), 2024, 2), (season_of(1)[:50], 2024, 3)],
        "text string, season int, version long",
    )
    read = docs.parse_documents(text, "text", docs.SCHEDULE, ["season", "version"])
    sync(spark, landed, where, *SPAN, schedules=read)
    assert games_of(spark, where) == [1, 2, 3]
    sync(spark, landed, where, *SPAN, schedules=read, whole_seasons=True)
    assert games_of(spark, where) == [3]
