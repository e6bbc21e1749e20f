"""Registered queries: library calls over frames made from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sample
from pitchlake.catalog.columns import TableLayout
from pitchlake.catalog.games import GAMES, UMPIRES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.catalog.support import DICTIONARY, QUARANTINE
from pitchlake.operators import colocate, compare, quality, runs, tables
from pitchlake.operators.conform import conform, drift, lost_values
from pitchlake.operators.dictionary import apply_dictionary
from pitchlake.operators.versions import Conflict, VersionedTable, days
from pitchlake.plans import curated, feed, games, metrics, states, verify
from pitchlake.plans.sync import SyncTables, sync
from pitchlake.session import compiled_rows
from pitchlake.sources import documents, manifest
from pitchlake.sources import leaderboard as boards
from pitchlake.sources.pitches import distinct_games, pitch_batch

Query = Callable[[SparkSession, str], DataFrame]

SEASON = 2024
MAY = (date(2024, 5, 1), date(2024, 5, 31))
OWN_SWINGS = ("swinging_strike", "swinging_strike_blocked", "foul", "hit_into_play")
FLOOR = {"batter": 5, "pitcher": 20}
# An outside board has its own, higher cut on its first metric's sample.
BOARD_FLOOR = {"batter": 8, "pitcher": 100}


def plain(frame: DataFrame) -> DataFrame:
    """The same rows in types that compare alike in every engine."""
    def shown(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            value = F.round(value, 6)
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            value = F.unix_seconds(value)
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, "|")
        return value.alias(field.name)

    return frame.select(*[shown(f) for f in frame.schema.fields])


def _pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.pitches(spark, sf_dir)


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = sample.schedule_documents(spark, sf_dir)
    found = documents.parse_documents(texts, "text", documents.SCHEDULE, ["version"])
    return documents.schedule_games(found)


def _boxscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = sample.boxscore_documents(spark, sf_dir)
    return documents.parse_documents(texts, "text", documents.BOXSCORE, ["version"])


def _umpires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.game_officials(_pitches(spark, sf_dir), _boxscores(spark, sf_dir))


def _standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = metrics.team_records(_pitches(spark, sf_dir), SEASON)
    texts = sample.standings_documents(records, SEASON)
    found = documents.parse_documents(texts, "text", documents.STANDINGS, ["version"])
    return documents.standings(found)


def _board(spark: SparkSession, sf_dir: str, entity: str = "batter") -> DataFrame:
    """A leaderboard made from our own values, each a little off, of players with a larger sample.

    Where two metrics are compared with the same field, the field holds the later metric's value.
    """
    fields = {metrics.METRICS[n].board_field: n for n in metrics.metrics_of(entity)}
    ours = metrics.player_metrics(
        _pitches(spark, sf_dir), list(fields.values()), SEASON, FLOOR[entity]
    )
    off = (F.col("id") % 7 - 3) * 0.002 + (F.col("id") % 100) * 0.000013 + 0.0000002
    scale = F.create_map(*[
        F.lit(x) for n in fields.values() for x in (n, metrics.METRICS[n].board_scale)
    ])
    first = metrics.metrics_of(entity)[0]
    wide = (
        ours.withColumn("shown", (F.col("value") + off) / scale[F.col("metric")])
        .groupBy("id")
        .agg(
            F.max(F.when(F.col("metric") == first, F.col("sample_size"))).alias("attempts"),
            *[
                F.max(F.when(F.col("metric") == n, F.col("shown"))).alias(field)
                for field, n in fields.items()
            ],
        )
        .where(F.col("attempts") >= BOARD_FLOOR[entity])
    )
    return wide.withColumnRenamed("id", "player_id").withColumn(
        boards.NAME, F.when(F.col("player_id") % 2 == 0, F.concat(F.lit("Player "), "player_id"))
    )


def _compare_players(
    spark: SparkSession, sf_dir: str, entity: str, names: list[str] | None = None
) -> DataFrame:
    wanted = names or metrics.metrics_of(entity)
    board = _board(spark, sf_dir, entity)
    return verify.verify_players(
        _pitches(spark, sf_dir), boards.expected_values(board, wanted), entity, SEASON,
        names=wanted, min_n=FLOOR[entity], player_names=boards.player_names(board),
    )


def _compare_batting(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return _compare_players(spark, sf_dir, "batter", list(names))


def _summary_batting(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = verify.metric_names(spark, metrics.metrics_of("batter"))
    return compare.summarise_metrics(_compare_batting(spark, sf_dir), wanted, threshold=0.5)


def _summary(entity: str, threshold: float) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        if entity == "team":
            found = verify.verify_teams(_pitches(spark, sf_dir), _standings(spark, sf_dir), SEASON)
        else:
            found = _compare_players(spark, sf_dir, entity)
        names = verify.metric_names(spark, metrics.metrics_of(entity))
        return compare.overall(compare.summarise_metrics(found, names, threshold))

    return query


def _two_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected contact value from a board of its own, with its own sample size and minimum."""
    board = _board(spark, sf_dir)
    second = board.select("player_id", (F.col("attempts") + 2).alias("pa"), "est_woba")
    first = [n for n in metrics.metrics_of("batter") if n != "xwoba_contact"]
    expected = boards.expected_from([
        boards.Board(board.drop("est_woba"), tuple(first), "attempts", 9),
        boards.Board(second, ("xwoba_contact",), "pa", 13),
    ])
    return verify.verify_players(
        _pitches(spark, sf_dir), expected, "batter", SEASON, min_n=FLOOR["batter"],
        player_names=boards.player_names(board),
    )


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of all batting metrics, written as JSON and read again."""
    _, location = scratch_database(spark)
    table = verify.metric_table(spark, metrics.metrics_of("batter"))
    found = compare.results(_compare_players(spark, sf_dir, "batter"), table, SEASON, "board")
    tables.write_report(found, f"{location}/results")
    read = spark.read.schema(found.schema).json(f"{location}/results")
    return read.select(
        "metric", "season", "aggregation", "tolerance", "threshold", "total_compared", "within_count",
        "pct_within", "passed", F.size("deltas").cast("bigint").alias("n_deltas"),
        F.get("deltas", F.lit(0))["entity_id"].alias("worst_id"),
        F.get("deltas", F.lit(0))["diff"].alias("worst_diff"),
    )


def _seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games of two seasons from landed files, a folder for each season."""
    _, location = scratch_database(spark)
    landed = sample.schedule_documents(spark, sf_dir).where("version = 2")
    year = F.regexp_extract("text", '"season":"([0-9]+)"', 1)
    landed.select("text", year.alias("year")).write.partitionBy("year").text(f"{location}/landed")
    paths = {s: [f"{location}/landed/year={s}"] for s in (2023, 2024)}
    return documents.schedule_seasons(spark, paths)


def _pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of May from a written table: the filter leaves their partitions only."""
    database, _ = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.pitches")
    tables.create_table(spark, name, PITCHES)
    year = (date(SEASON, 1, 1), date(SEASON, 12, 31))
    tables.replace_days(pitch_batch(_pitches(spark, sf_dir), *year), name, PITCHES, *year)
    may = F.col("game_date").between(F.lit(MAY[0]), F.lit(MAY[1]))
    return spark.table(str(name)).where(may).groupBy("game_date").agg(
        F.count("*").alias("pitches"), F.avg("launch_speed").alias("launch_speed")
    )


def _board_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, location = scratch_database(spark)
    _board(spark, sf_dir).write.option("header", True).csv(f"{location}/board")
    board = boards.read_leaderboard(spark, f"{location}/board", "csv")
    return boards.expected_values(board, ["barrel_rate"], sample_column="attempts", min_sample=10)


def scratch_database(spark: SparkSession) -> tuple[str, str]:
    """A new database under the cluster's shared folder, and that folder.

    The setting ``spark.checkpoint.dir`` names the folder; where it is unset, the warehouse, which
    all executors share as well.
    """
    tag = f"pitchlake_{uuid.uuid4().hex[:12]}"
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    shared = spark.conf.get("spark.checkpoint.dir", None) or warehouse
    location = f"{shared.rstrip('/')}/{tag}"
    spark.sql(f"CREATE DATABASE {tag} LOCATION '{location}'")
    return f"spark_catalog.{tag}", location


def _replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.pitches")
    tables.create_table(spark, name, PITCHES)
    landed = _pitches(spark, sf_dir)
    year = (date(SEASON, 1, 1), date(SEASON, 12, 31))
    tables.replace_days(pitch_batch(landed, *year), name, PITCHES, *year)
    # The second load brings fewer games, so that some days of May have none any more.
    again = landed.where(F.col("home_team") < "M")
    tables.replace_days(pitch_batch(again, *MAY), name, PITCHES, *MAY)
    return spark.table(str(name)).groupBy("game_date").agg(
        F.count("*").alias("pitches"), F.sum("batter").alias("batters")
    )


def _replace_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day before and after a span was replaced, while a late writer of that span is refused."""
    _, location = scratch_database(spark)
    table = VersionedTable(f"{location}/pitches", PITCHES)
    landed = _pitches(spark, sf_dir)
    year = (date(SEASON, 1, 1), date(SEASON, 12, 31))
    table.replace_days(pitch_batch(landed, *year), *year)
    seen = table.version(spark)
    span = (date(SEASON, 4, 2), MAY[1])
    table.replace(pitch_batch(landed.where(F.col("home_team") < "M"), *span), days("game_date", *span))
    try:
        table.replace_days(pitch_batch(landed, *span), *span, base=seen)
        refused = False
    except Conflict:
        refused = True

    def by_day(number: int, name: str) -> DataFrame:
        return table.read(spark, number).groupBy("game_date").agg(F.count("*").alias(name), F.sum("batter").alias(f"{name}_batters"))

    found = by_day(seen.number, "before").join(by_day(table.version(spark).number, "after"), "game_date", "left")
    return found.withColumn("refused", F.lit(refused))


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of a filled table whose every third column had another one, with the values in each column."""
    database, _ = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.games")
    old = TableLayout(
        tuple(replace(c, description="To be described.") if i % 3 == 0 else c for i, c in enumerate(GAMES.columns)),
        GAMES.comment, GAMES.partition_by,
    )
    tables.create_table(spark, name, old)
    tables.replace_seasons(_games(spark, sf_dir), name, GAMES, range(2022, 2026))
    changed = tables.apply_comments(spark, name, GAMES)
    told = [(f.name, f.metadata.get("comment")) for f in spark.table(str(name)).schema.fields]
    filled = quality.profile(spark.table(str(name)), GAMES).select("column_name", "non_null")
    return filled.join(
        spark.createDataFrame(told, "column_name string, description string"), "column_name"
    ).withColumn("changed", F.lit(changed))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games from landed files among which newer ones are cut off or no answer, and what was put aside."""
    database, location = scratch_database(spark)
    texts = sample.schedule_documents(spark, sf_dir).where("version = 2").select(
        "text", F.regexp_extract("text", '"season":"([0-9]+)"', 1).alias("season"),
        F.regexp_extract("text", '"gamePk":([0-9]+)', 1).cast("long").alias("g"),
    )
    cut = texts.where("g % 5 = 0").select(F.expr("substring(text, 1, length(text) div 2)").alias("text"), "season")
    busy = texts.where("g % 7 = 0").select(F.lit('{"message":"busy"}').alias("text"), "season")
    for batch in (texts.select("text", "season"), cut, busy):
        batch.write.mode("append").partitionBy("season").text(f"{location}/landed")
    name = tables.TableName.parse(f"{database}.damaged")
    tables.create_table(spark, name, QUARANTINE)
    landed = documents.read_documents(spark, f"{location}/landed", documents.SCHEDULE)
    counted = documents.put_aside(landed, name)
    aside = spark.table(str(name)).groupBy(
        F.col("reason").alias("name"), F.col("season").cast("string").alias("slice")
    ).agg(F.count("*").alias("n"))
    whole = spark.createDataFrame([(r, "all", n) for r, n in counted.items()], "name string, slice string, n long")
    games = documents.schedule_games(landed).groupBy(F.col("season").cast("string").alias("slice")).agg(
        F.sum("final_home_score").alias("n")
    )
    return aside.unionByName(whole).unionByName(games.withColumn("name", F.lit("home runs")))


@contextmanager
def _landing_months(spark: SparkSession) -> Iterator[None]:
    """A task lands its rows in the files of all months at once, a dozen a batch, in place of sorting them first."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16")
    try:
        with compiled_rows(spark):
            yield
    finally:
        spark.conf.set(setting, before)


def _landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a range from landed files, a folder a month, that came in two batches with other columns."""
    database, location = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.landed_files")
    landed = _pitches(spark, sf_dir).withColumn("month", F.date_format("game_date", "yyyy-MM"))
    early = landed.where("game_year < 2024").drop("bat_speed")
    late = landed.where("game_year >= 2024").withColumn("batter", F.col("batter").cast("string"))
    noted = 0
    for batch in (early, late):
        with _landing_months(spark):
            batch.write.mode("append").partitionBy("month").parquet(f"{location}/landing")
        noted += manifest.extend(spark, f"{location}/landing", name)
    span = (date(2023, 4, 3), date(2024, 5, 31))
    told = spark.table(str(name)).agg(F.sum("rows").alias("n"), F.count("*").alias("files")).first()
    return manifest.read_range(spark, name, *span).groupBy("game_date").agg(
        F.count("*").alias("pitches"), F.sum("batter").alias("batters"), F.sum("bat_speed").alias("bat_speed")
    ).withColumn("rows_noted", F.lit(told["n"])).withColumn("once", F.lit(told["files"] == noted))


def _z_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pitches of some away teams, from a table that is clustered on three columns at once."""
    database, _ = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.pitches")
    tables.create_table(spark, name, PITCHES)
    year = (date(SEASON, 1, 1), date(SEASON, 12, 31))
    tables.replace_days(
        pitch_batch(_pitches(spark, sf_dir), *year), name, PITCHES, *year, z_order=("away_team", "game_pk", "pitcher")
    )
    return spark.table(str(name)).where(F.col("away_team").isin("NYY", "BOS", "SEA")).groupBy("away_team", "game_pk").agg(
        F.count("*").alias("pitches"), F.sum("pitcher").alias("pitchers"), F.avg("release_speed").alias("release_speed")
    )


REPLACED = (date(SEASON, 4, 2), MAY[1])


def _states(spark: SparkSession, sf_dir: str, *kept: str) -> states.StateTables:
    """The given states of all seasons, kept while a span of days was replaced by fewer games."""
    database, _ = scratch_database(spark)
    made = states.StateTables(tables.TableName.parse(f"{database}.pitches"), kept)
    tables.create_table(spark, made.pitches, PITCHES)
    landed, all_days = _pitches(spark, sf_dir), (date(2022, 1, 1), date(2025, 12, 31))
    states.replace_days(pitch_batch(landed, *all_days), made, *all_days)
    fewer = pitch_batch(landed.where(F.col("home_team") < "M"), *REPLACED)
    states.replace_days(fewer, made, *REPLACED, keep_when_empty=False)
    return made


def _state_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _states(spark, sf_dir, "contact_days").read(spark, "contact_days")
    return states.league_barrel_rate(days).join(states.exit_velocity_by_season(days).drop("bbe"), "game_year")


def _state_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.velocity_by_pitch_type(_states(spark, sf_dir, "velocity_days").read(spark, "velocity_days"))


def _state_tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.pitch_tempo(_states(spark, sf_dir, "game_days").read(spark, "game_days"))


def _by_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work of the plate umpires and finished games, from tables that lie by game, for each kind of game."""
    database, _ = scratch_database(spark)
    seasons, buckets = range(2022, 2026), 16
    made = {}
    for kind, layout, frame in (
        ("pitches", colocate.pitches_by_game(buckets), _pitches(spark, sf_dir)),
        ("umpires", colocate.umpires_by_game(buckets), colocate.with_season(_umpires(spark, sf_dir))),
        ("games", colocate.games_by_game(buckets), _games(spark, sf_dir)),
    ):
        name = tables.TableName.parse(f"{database}.{kind}")
        tables.create_table(spark, name, layout)
        tables.replace_seasons(frame, name, layout, seasons)
        made[kind] = spark.table(str(name))
    missing = quality.games_without_pitches(made["games"], made["pitches"].where(F.col("game_type") == "R"), ("R", "D"))
    work = games.plate_umpire_workload(made["pitches"], made["umpires"])
    return work.select(
        F.lit("umpire").alias("kind"), F.col("umpire_id").alias("id"), "games", "pitches"
    ).unionByName(missing.select(
        F.lit("game").alias("kind"), F.col("game_pk").alias("id"), F.lit(1).cast("long").alias("games"), F.lit(0).cast("long").alias("pitches")
    ))


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What some pitchers threw to some batters, looked up in a table whose files hold filters of both."""
    database, _ = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.pitches")
    tables.create_table(spark, name, PITCHES)
    year = (date(SEASON, 1, 1), date(SEASON, 12, 31))
    tables.replace_days(pitch_batch(_pitches(spark, sf_dir), *year), name, PITCHES, *year)
    table = spark.table(str(name))
    some = [r[0] for r in table.groupBy("pitcher").count().orderBy(F.desc("count"), "pitcher").limit(3).collect()]
    return table.where(F.col("pitcher").isin(some)).groupBy("pitcher", "batter").agg(
        F.count("*").alias("pitches"), F.avg("release_speed").alias("release_speed")
    )


def _state_batting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.batting_metrics(_states(spark, sf_dir, "batter_days").read(spark, "batter_days"), SEASON, min_n=FLOOR["batter"])


def _state_spin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean spin from states, and whether the ranks of both quantiles are within the stated bound."""
    made = _states(spark, sf_dir, "spin_days")
    told = states.spin_distribution(made.read(spark, "spin_days"))
    spins = spark.table(str(made.pitches)).where("release_spin_rate IS NOT NULL").groupBy("pitch_type", "release_spin_rate").count()
    ranks = spins.join(told, spins["pitch_type"].eqNullSafe(told["pitch_type"])).groupBy(told["pitch_type"], "avg_spin", "pitches")

    def share(quantile: str, condition: str) -> Column:
        return F.sum(F.when(F.expr(f"release_spin_rate {condition} {quantile}"), F.col("count")).otherwise(0)) / F.col("pitches")

    def within(quantile: str, wanted: float) -> Column:
        error = states.RANK_ERROR
        return (share(quantile, "<") <= wanted + error) & (share(quantile, "<=") >= wanted - error)

    return ranks.agg(within("p50", 0.5).alias("p50_within"), within("p90", 0.9).alias("p90_within"))


def _replace_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.games")
    tables.create_table(spark, name, GAMES)
    found = _games(spark, sf_dir)
    tables.replace_seasons(found, name, GAMES, [2022, 2023, 2024, 2025])
    again = found.where((F.col("season") == 2024) & (F.col("status_code") == "F"))
    tables.replace_seasons(again, name, GAMES, [2023, 2024])
    return spark.table(str(name)).groupBy("season", "status_code").agg(
        F.count("*").alias("games"), F.sum("final_home_score").alias("home_runs")
    )


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = scratch_database(spark)
    name = tables.TableName.parse(f"{database}.dictionary")
    tables.create_table(spark, name, DICTIONARY)
    apply_dictionary(spark, name, GAMES, "baseball", "games")
    apply_dictionary(spark, name, PITCHES, "baseball", "pitches")
    apply_dictionary(spark, name, PITCHES, "baseball", "pitches")
    entries = spark.table(str(name)).where("dataset = 'baseball' AND `table` = 'pitches'")
    filled = quality.profile(conform(_pitches(spark, sf_dir), PITCHES), PITCHES)
    return entries.select(F.col("column").alias("column_name"), "dtype", "tags").join(
        filled.select("column_name", "non_null"), "column_name"
    )


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, location = scratch_database(spark)
    found = _compare_batting(spark, sf_dir, "barrel_rate")
    tables.write_report(found, f"{location}/report")
    return spark.read.schema(found.schema).json(f"{location}/report")


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _pitches(spark, sf_dir).withColumn("miss_distance", F.lit(1.0))
    found = drift(landed, PITCHES)
    pairs = [("unknown", c) for c in found.unknown] + [("missing", c) for c in found.missing]
    seen = landed.agg(F.count("*").alias("rows_seen"))
    return seen.select(
        F.inline(F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column_name")) for kind, c in pairs
        ])),
        "rows_seen",
    )


def _daily_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a season that landed in two parts, of which the second brings late games of many days."""
    database, location = scratch_database(spark)
    name, files = (tables.TableName.parse(f"{database}.{n}") for n in ("pitches", "landed_files"))
    landed = _pitches(spark, sf_dir).where(F.col("game_year") == SEASON)
    runs_of_days = []
    for part in (landed.where("game_pk % 3 > 0"), landed.where("game_pk % 3 = 0"), None):
        if part is not None:
            with compiled_rows(spark):
                part.write.mode("append").parquet(f"{location}/landing")
        runs_of_days.append(feed.load_new_files(spark, f"{location}/landing", name, files, f"{location}/place"))
    return spark.table(str(name)).groupBy("game_date").agg(
        F.count("*").alias("pitches"), F.sum("batter").alias("batters")
    ).withColumn("loaded_again", F.lit(len(runs_of_days[-1])))


def _lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a batch that landed as text or with fractions and do not fit the table."""
    landed = _pitches(spark, sf_dir).withColumns({
        "batter": F.when(F.col("pitcher") % 4 == 0, "9223372036854775808").otherwise(F.col("batter").cast("string")),
        "zone": F.when(F.col("zone") == 3, 3.5).otherwise(F.col("zone").cast("double")),
        "release_speed": F.when(F.col("zone") == 5, "n/a").otherwise(F.col("release_speed").cast("string")),
    })
    found = conform(landed, PITCHES).agg(*[F.count(c).alias(c) for c in ("batter", "zone", "release_speed")])
    kept = found.selectExpr("stack(3, 'batter', batter, 'zone', zone, 'release_speed', release_speed) AS (column_name, kept)")
    return lost_values(landed, PITCHES).where("lost > 0").join(kept, "column_name")


def _month_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month chunks of the whole table, with how many pitches each covers."""
    days = _pitches(spark, sf_dir).groupBy("game_date").agg(F.count("*").alias("n"))
    bounds = days.agg(F.min("game_date").alias("start"), F.max("game_date").alias("end"))
    wanted = runs.chunk_table(bounds, "month")
    loaded = days.groupBy(F.trunc("game_date", "month").alias("month")).agg(
        F.sum("n").alias("pitches")
    )
    return wanted.join(
        loaded, F.trunc("chunk_start", "month") == F.col("month"), "left"
    ).select("chunk_start", "chunk_end", F.coalesce("pitches", F.lit(0)).alias("pitches"))


def _pending_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _month_chunks(spark, sf_dir)
    attempts = wanted.withColumn(
        "status",
        F.when(F.col("pitches") == 0, "empty")
        .when(F.month("chunk_start") % 2 == 0, "success")
        .otherwise("failed"),
    )
    return runs.pending(wanted.select("chunk_start", "chunk_end"), runs.completed(attempts))


def _sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = scratch_database(spark)
    where = SyncTables.beside(f"{database}.pitches")
    schedules = documents.parse_documents(
        sample.schedule_documents(spark, sf_dir), "text", documents.SCHEDULE, ["version"]
    )
    span = (date(2024, 4, 10), date(2024, 6, 20))
    sync(spark, _pitches(spark, sf_dir), where, *span, boxscores=_boxscores(spark, sf_dir),
         schedules=schedules, chunk_kind="month")

    def counted(name: tables.TableName, label: str, slice_by: str) -> DataFrame:
        return spark.table(str(name)).groupBy(F.col(slice_by).cast("string").alias("slice")).agg(
            F.count("*").alias("n")
        ).select(F.lit(label).alias("name"), "slice", "n")

    log = spark.table(str(where.runs)).select(
        F.concat(F.lit("log "), "status").alias("name"),
        F.col("chunk_start").cast("string").alias("slice"),
        F.col("rows_written").alias("n"),
    )
    return (
        counted(where.pitches, "pitches", "game_date")
        .unionByName(counted(where.umpires, "umpires", "game_date"))
        .unionByName(counted(where.games, "games", "season"))
        .unionByName(log)
    )


def _over_pitches(call: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: call(_pitches(spark, sf_dir), **options)


def _with_umpires(call: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: call(
        _pitches(spark, sf_dir), _umpires(spark, sf_dir), **options
    )


def _check(source: Callable[[SparkSession, str], DataFrame], layout, *kinds: str) -> Query:
    return lambda spark, sf_dir: quality.check_columns(
        conform(source(spark, sf_dir), layout), layout, kinds
    )


# Thresholds are smaller than the published ones so that small inputs give rows, too.
CURATED: dict[str, Query] = {
    "q01_league_barrel_rate": _over_pitches(curated.league_barrel_rate),
    "q02_top_hard_hit": _over_pitches(curated.top_hard_hit, season=SEASON, min_n=5),
    "q03_umpire_called_strike_30d": _with_umpires(
        curated.umpire_called_strikes, as_of=MAY[1], min_n=20
    ),
    "q04_umpire_edge_zone": _with_umpires(curated.umpire_edge_strikes),
    "q05_whiff_by_hand": _over_pitches(curated.whiff_by_hand),
    "q05_whiff_own_swings": _over_pitches(curated.whiff_by_hand, swings=OWN_SWINGS),
    "q17_last_pitch": _over_pitches(curated.run_expectancy, last_pitch=True),
    "q06_starter_ev_allowed": _over_pitches(curated.starter_exit_velocity),
    "q07_xwoba_contact": _over_pitches(curated.xwoba_on_contact, season=SEASON, min_n=8),
    "q08_pitches_per_pa": _over_pitches(curated.pitches_per_plate_appearance),
    "q09_sweet_spot": _over_pitches(curated.sweet_spot_leaders, min_n=20),
    "q10_bat_speed": _over_pitches(curated.bat_speed_leaders, min_n=20),
    "q11_k_rate_02": _over_pitches(curated.strikeouts_ahead, min_n=5),
    "q12_velo_by_pitch_type": _over_pitches(curated.velocity_by_pitch_type),
    "q13_spin_distribution": _over_pitches(curated.spin_distribution),
    "q14_usage_by_count": _over_pitches(curated.usage_by_count),
    "q15_pa_results_by_inning": _over_pitches(curated.results_by_inning),
    "q16_late_hard_hit_allowed": _over_pitches(curated.late_hard_hit_allowed),
    "q17_run_expectancy_24": _over_pitches(curated.run_expectancy),
    "q18_runner_on_first": _over_pitches(curated.pitches_with_runner_on_first),
    "q19_late_and_close": _over_pitches(curated.late_and_close),
    "q20_ev_trend": _over_pitches(curated.exit_velocity_by_season),
    "q21_pitch_tempo": _over_pitches(curated.pitch_tempo),
    "q22_two_strike": _over_pitches(curated.two_strike_results, min_n=8),
    "q23_catcher_framing": _over_pitches(curated.catcher_framing, min_n=30),
    "q24_park_ev": _over_pitches(curated.park_exit_velocity, min_n=100),
    "q25_team_game_line": _over_pitches(curated.team_game_lines),
}


def _metric_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for spec in metrics.METRICS.values():
        if spec.entity == "team":
            found[f"s_{spec.name}"] = _over_pitches(
                metrics.team_metric, name=spec.name, season=SEASON
            )
        else:
            found[f"m_{spec.name}"] = _over_pitches(
                metrics.player_metric, name=spec.name, season=SEASON, min_n=FLOOR[spec.entity]
            )
    for key, entity in (("m_batting_all", "batter"), ("m_pitching_all", "pitcher")):
        found[key] = _over_pitches(
            metrics.player_metrics, names=metrics.metrics_of(entity), season=SEASON,
            min_n=FLOOR[entity],
        )
    found["w1_final_scores"] = _over_pitches(metrics.final_scores, season=SEASON)
    return found


VERIFY: dict[str, Query] = {
    "v_compare_batting": _compare_batting,
    "v_compare_pitching": lambda s, d: _compare_players(s, d, "pitcher"),
    "v_summary_batting": _summary_batting,
    "v_overall_batting": lambda s, d: compare.overall(_summary_batting(s, d)),
    "v_top_deltas": lambda s, d: compare.top_deltas(_compare_batting(s, d, "barrel_rate")),
    "v_compare_teams": lambda s, d: verify.verify_teams(_pitches(s, d), _standings(s, d), SEASON),
    "v_report_json": _report,
    "v_two_boards": _two_boards,
    "v_results_json": _results,
    "v_overall_batting_099": _summary("batter", 0.99),
    "v_overall_pitching": _summary("pitcher", 0.5),
    "v_overall_pitching_099": _summary("pitcher", 0.99),
    "v_overall_teams": _summary("team", 0.5),
    "v_overall_teams_099": _summary("team", 0.99),
}

SOURCES: dict[str, Query] = {
    "src_pitch_batch": lambda s, d: pitch_batch(_pitches(s, d), *MAY).select(
        "game_pk", "at_bat_number", "pitch_number", "game_date", "sv_id", "batter", "pitcher",
        "description", "launch_speed", "swing_length",
    ),
    "src_schedule_games": _games,
    "src_schedule_kinds": lambda s, d: documents.schedule_games(
        documents.parse_documents(
            sample.schedule_documents(s, d), "text", documents.SCHEDULE, ["version"]
        ), documents.INGESTED,
    ),
    "src_schedule_seasons": _seasons,
    "src_leaderboard_file": _board_file,
    "src_game_officials": _umpires,
    "src_distinct_games": _over_pitches(distinct_games),
    "src_standings": _standings,
    "src_damaged_documents": _damaged,
    "src_landing_manifest": _landing_manifest,
    "src_leaderboard": lambda s, d: boards.expected_values(
        _board(s, d), ["barrel_rate"], sample_column="attempts", min_sample=10
    ),
}

GAME_QUESTIONS: dict[str, Query] = {
    "g_results_on": lambda s, d: games.results_on(_games(s, d), MAY[0]),
    "g_slate_on": lambda s, d: games.slate_on(_games(s, d), date(2024, 4, 19)),
    "a15_result_counts": _over_pitches(games.result_counts),
    "a16_starters": lambda s, d: games.announced_and_actual_starters(_pitches(s, d), _games(s, d)),
    "j6_plate_umpires": _with_umpires(games.plate_umpire_workload),
    "x_strike_zone_calls": _over_pitches(games.strike_zone_calls),
}

QUALITY: dict[str, Query] = {
    "d1_not_null": _check(_pitches, PITCHES, "not_null"),
    "d2_valid_range": _check(_pitches, PITCHES, "valid_range"),
    "d3_valid_values": _check(_pitches, PITCHES, "valid_values"),
    "d3_games_rules": _check(_games, GAMES, "not_null", "valid_range", "valid_values"),
    "d3_umpire_rules": _check(_umpires, UMPIRES, "not_null", "valid_range", "valid_values"),
    "d4_duplicates": _over_pitches(quality.duplicates, layout=PITCHES),
    "d5_drift": _drift,
    "d5_lost_values": _lost,
    "d6_profile": lambda s, d: quality.profile(conform(_pitches(s, d), PITCHES), PITCHES),
    "d7_deprecated": _check(_pitches, PITCHES, "deprecated"),
    "d8_games_without_pitches": lambda s, d: quality.games_without_pitches(
        _games(s, d), _pitches(s, d).where(F.col("game_type") == "R"), ("R", "D")
    ),
    "d8_games_without_umpire": _with_umpires(quality.games_without_plate_umpire),
}

TABLES: dict[str, Query] = {
    "t_replace_days": _replace_days,
    "t_replace_seasons": _replace_seasons,
    "t_replace_atomic": _replace_atomic,
    "t_comments": _comments,
    "t_z_order": _z_order,
    "st_season_lines": _state_seasons,
    "st_velocity": _state_velocity,
    "st_batting_metrics": _state_batting,
    "st_spin": _state_spin,
    "st_pitch_tempo": _state_tempo,
    "t_by_game": _by_game,
    "t_point_lookup": _lookup,
    "t_pruned_scan": _pruned,
    "t_dictionary": _dictionary,
    "r_month_chunks": _month_chunks,
    "r_pending_chunks": _pending_chunks,
    "r_sync_tables": _sync,
    "r_daily_feed": _daily_feed,
}


def all_queries() -> dict[str, Query]:
    groups = (CURATED, _metric_queries(), VERIFY, SOURCES, GAME_QUESTIONS, QUALITY, TABLES)
    merged = {key: query for group in groups for key, query in group.items()}
    return {key: _plain(query) for key, query in merged.items()}


def _plain(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(spark, sf_dir))
