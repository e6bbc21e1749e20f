"""Landed JSON documents: season schedules, box scores and standings.

Every leaf is read as text and converted leniently, so one bad value never fails a load.

Landed documents pile up: a season or a box score arrives again with every load. A column ``version``
orders them, and only the newest counts. Files have their modification time as version; documents
without one count as equally new.

A document that cannot be read (a cut-off file) or that is no answer (an error message in its place) is
damaged: it has no part in any of the frames here, so an older document stays in force, and
``damaged_documents`` tells which they are and why.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.catalog.games import GAMES, UMPIRE_POSITIONS, UMPIRES
from pitchlake.catalog.support import QUARANTINE
from pitchlake.catalog.teams import teams
from pitchlake.functions.parse import safe_int, text_or
from pitchlake.operators.tables import TableName
from pitchlake.sources.pitches import distinct_games


VERSION = "version"
FILE = "file"
# The text of a document that could not be read; null for all others.
UNREADABLE = "unreadable"
# The list that makes a document an answer, by kind.
ANSWER = {"schedule": "dates", "boxscore": "officials", "standings": "records"}
# Regular season and the four rounds after it; spring and exhibition games are not ingested.
INGESTED = ("R", "P", "F", "D", "L", "W")


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


_SIDE = T.StructType([
    T.StructField("team", T.StructType(_text("id", "name", "abbreviation"))),
    *_text("score"),
    T.StructField("probablePitcher", T.StructType(_text("id", "fullName"))),
])
_GAME = T.StructType([
    *_text("gamePk", "season", "gameDate", "officialDate", "gameType", "doubleHeader",
           "gameNumber", "seriesDescription"),
    T.StructField("status", T.StructType(_text("codedGameState", "detailedState"))),
    T.StructField("teams", T.StructType([
        T.StructField("home", _SIDE), T.StructField("away", _SIDE),
    ])),
    T.StructField("venue", T.StructType(_text("id", "name"))),
])
SCHEDULE = T.StructType([
    T.StructField("dates", T.ArrayType(T.StructType([
        T.StructField("games", T.ArrayType(_GAME)),
    ]))),
])
BOXSCORE = T.StructType([
    T.StructField("game_pk", T.LongType()),
    T.StructField("officials", T.ArrayType(T.StructType([
        T.StructField("official", T.StructType(_text("id", "fullName"))),
        *_text("officialType"),
    ]))),
])
STANDINGS = T.StructType([
    T.StructField("season", T.LongType()),
    T.StructField("records", T.ArrayType(T.StructType([
        T.StructField("teamRecords", T.ArrayType(T.StructType([
            T.StructField("team", T.StructType(_text("id", "name"))),
            *_text("wins", "losses", "runsScored", "runsAllowed"),
        ]))),
    ]))),
])


def read_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    one_per_file: bool = False,
) -> DataFrame:
    """Landed documents, one per line or one per file. A missing path is an error, not no data.

    Fields that the landing layout carries in its folders (``game_pk=7/``, ``season=2024/``)
    become columns by themselves; the files' modification times become ``version``, their paths ``file``.
    The text of what cannot be read is in ``unreadable``.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    found = (
        spark.read.schema(_with_unreadable(schema))
        .option("columnNameOfCorruptRecord", UNREADABLE).option("multiLine", one_per_file).json(paths)
    )
    return found.withColumns({
        VERSION: F.unix_micros(F.col("_metadata.file_modification_time")), FILE: F.col("_metadata.file_path"),
    })


def _with_unreadable(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])


def parse_documents(
    frame: DataFrame, text: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """Like ``read_documents`` for documents held in the text column ``text``.

    Columns in ``keep``, such as ``version`` or the season of the landing, stay beside the document.
    """
    options = {"columnNameOfCorruptRecord": UNREADABLE}
    parsed = frame.select(F.from_json(F.col(text), _with_unreadable(schema), options).alias("doc"), *keep)
    return parsed.select("doc.*", *keep)


def kind_of(documents: DataFrame) -> str:
    for kind, answer in ANSWER.items():
        if answer in documents.columns:
            return kind
    raise ValueError(f"no documents of a known kind; columns: {documents.columns}")


def is_sound(documents: DataFrame) -> Column:
    """Whether a document could be read and is an answer, be it an empty one."""
    found = F.col(ANSWER[kind_of(documents)]).isNotNull()
    return found & F.col(UNREADABLE).isNull() if UNREADABLE in documents.columns else found


def damaged_documents(documents: DataFrame) -> DataFrame:
    """The damaged documents as rows of the table ``QUARANTINE``."""
    kind = kind_of(documents)
    unreadable = F.col(UNREADABLE) if UNREADABLE in documents.columns else F.lit(None).cast("string")
    told = {
        "kind": F.lit(kind),
        "reason": F.when(unreadable.isNotNull(), "unreadable").otherwise("no answer"),
        "document": unreadable,
        "seen_at": F.current_timestamp(),
    }
    return documents.where(~is_sound(documents)).select(*[
        told.get(c.name, F.col(c.name) if c.name in documents.columns else F.lit(None)).cast(c.dtype).alias(c.name)
        for c in QUARANTINE.columns
    ])


def put_aside(documents: DataFrame, name: TableName) -> dict[str, int]:
    """Append the damaged documents to the table ``name``; how many there are for each reason.

    They are counted while they are written, in one pass over the documents.
    """
    reasons = QUARANTINE["reason"].allowed
    seen = Observation()
    found = damaged_documents(documents).observe(
        seen, *[F.count_if(F.col("reason") == r).alias(f"n{i}") for i, r in enumerate(reasons)]
    )
    found.write.insertInto(str(name))
    return {r: n for i, r in enumerate(reasons) if (n := seen.get[f"n{i}"])}


def newest_of_each_season(documents: DataFrame) -> DataFrame:
    """The newest sound document of each landed ``season``: for documents that are a whole season.

    Numbers decide, one row for each season; the documents themselves are neither sorted nor dealt.
    """
    versioned = documents.withColumn("_version", _version(documents))
    newest = versioned.where(is_sound(documents)).groupBy("season").agg(F.max("_version").alias("_version"))
    return versioned.join(F.broadcast(newest), ["season", "_version"], "left_semi").select(*documents.columns)


def _version(documents: DataFrame) -> Column:
    found = F.col(VERSION) if VERSION in documents.columns else F.lit(0)
    return F.coalesce(found.cast("bigint"), F.lit(0).cast("bigint")).alias("_version")


def schedule_games(documents: DataFrame, game_types: Sequence[str] | None = None) -> DataFrame:
    """One row per scheduled game, with league and division of both teams.

    Of a game that is listed several times the newest document's entry counts, in it the later one.
    Games without an id or without both team ids are left out. A team that is not one of the
    thirty keeps the document's abbreviation, or UNK when there is none. ``game_types`` chooses the
    kinds of games, such as ``INGESTED``; by default all are kept.
    """
    # The outer forms keep Spark from testing the array in a filter below, which would parse a
    # text document once more; what they add for an empty array has no id and is left out below.
    day = documents.select(_version(documents), F.posexplode_outer("dates").alias("_i", "day"))
    game = day.select("_version", "_i", F.posexplode_outer("day.games").alias("_j", "g"))
    game = game.select("_version", "_i", "_j", "g.*")

    def side(which: str) -> list[Column]:
        entry = F.col("teams")[which]
        return [
            safe_int(entry["team"]["id"]).alias(f"{which}_team_id"),
            entry["team"]["abbreviation"].alias(f"_{which}_abbr"),
            safe_int(entry["score"]).alias(f"final_{which}_score"),
            safe_int(entry["probablePitcher"]["id"]).alias(f"probable_{which}_pitcher_id"),
            entry["probablePitcher"]["fullName"].alias(f"probable_{which}_pitcher_name"),
        ]

    flat = game.select(
        safe_int(F.col("gamePk")).alias("game_pk"),
        F.coalesce(safe_int(F.col("season")), F.lit(0)).alias("season"),
        F.try_to_date(F.col("officialDate")).alias("game_date"),
        F.try_to_timestamp(F.col("gameDate")).alias("game_datetime"),
        text_or(F.col("gameType"), "").alias("game_type"),
        text_or(F.col("status.codedGameState"), "").alias("status_code"),
        text_or(F.col("status.detailedState"), "").alias("status_detail"),
        *side("home"),
        *side("away"),
        safe_int(F.col("venue.id")).alias("venue_id"),
        F.col("venue.name").alias("venue_name"),
        F.col("doubleHeader").alias("double_header_flag"),
        safe_int(F.col("gameNumber")).alias("game_number"),
        F.col("seriesDescription").alias("series_description"),
        "_version", "_i", "_j",
    ).where("game_pk IS NOT NULL AND home_team_id IS NOT NULL AND away_team_id IS NOT NULL")
    columns = [c for c in flat.columns if c not in ("game_pk", "_version", "_i", "_j")]
    # A hash of the line decides between entries at the same place, so that it is carried once.
    place = F.struct("_version", "_i", "_j", F.xxhash64(*columns))
    newest = F.max_by(F.struct(*columns), place).alias("line")
    flat = flat.groupBy("game_pk").agg(newest).select("game_pk", "line.*")
    if game_types is not None:
        flat = flat.where(F.col("game_type").isin(list(game_types)))

    for which in ("home", "away"):
        dimension = teams(documents.sparkSession).select(
            F.col("team_id").alias(f"{which}_team_id"),
            F.col("abbr").alias("_known"),
            F.col("league").alias(f"{which}_league"),
            F.col("division").alias(f"{which}_division"),
        )
        flat = flat.join(F.broadcast(dimension), f"{which}_team_id", "left").withColumn(
            f"{which}_team_abbrev",
            F.coalesce("_known", text_or(F.col(f"_{which}_abbr"), "UNK")),
        ).drop("_known")
    return flat.select(*GAMES.names)


def empty_games(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], GAMES.schema)


def schedule_seasons(spark: SparkSession, paths_by_season: dict[int, list[str]]) -> DataFrame:
    """Games of several seasons in one read; no seasons give an empty frame."""
    paths = [p for season in sorted(paths_by_season) for p in paths_by_season[season]]
    if not paths:
        return empty_games(spark)
    return schedule_games(read_documents(spark, paths, SCHEDULE))


def game_officials(games: DataFrame, boxscores: DataFrame) -> DataFrame:
    """Umpire crew of each wanted (game_pk, game_date) that has a box score."""
    return crews_of(games, officials(boxscores))


def crews_of(games: DataFrame, flat: DataFrame) -> DataFrame:
    """Rows of ``officials`` for the games of a batch, with their days."""
    return distinct_games(games).join(flat, "game_pk").select(*UMPIRES.names)


def officials(boxscores: DataFrame) -> DataFrame:
    """(game_pk, position, umpire_id, umpire_name) from the newest box score of each game.

    Unknown titles and officials without an id are left out.
    """
    code = F.create_map(*[F.lit(x) for pair in UMPIRE_POSITIONS.items() for x in pair])
    # Without a list of officials a document has no place, and one without place is passed over.
    place = F.when(F.col("officials").isNotNull(), F.struct("_version", F.xxhash64("officials")))
    newest = boxscores.select("game_pk", "officials", _version(boxscores)).groupBy("game_pk").agg(
        F.max_by("officials", place).alias("officials")
    )
    return (
        newest.select(F.col("game_pk"), F.explode_outer("officials").alias("o"))
        .select(
            "game_pk",
            F.element_at(code, F.col("o.officialType")).alias("position"),
            safe_int(F.col("o.official.id")).alias("umpire_id"),
            F.col("o.official.fullName").alias("umpire_name"),
        )
        .where("position IS NOT NULL AND umpire_id IS NOT NULL")
    )


def standings(documents: DataFrame) -> DataFrame:
    """One row per season and team: wins, losses, runs scored and allowed.

    Only the newest documents of a season count: those of the newest version, and of landed files all in
    the folder that got the newest, so that a season may come as a file for each league. Of a team
    listed several times in these the newest entry counts, in a document the later one. Abbreviations are
    the pitch feed's. Unknown teams are left out.
    """
    batch = F.regexp_extract(FILE, "^.*/", 0) if FILE in documents.columns else _version(documents)
    landed = documents.select("season", "records", _version(documents), batch.alias("_batch"))
    # A row for each season, from numbers and folder names alone.
    newest = landed.where("season IS NOT NULL AND records IS NOT NULL").groupBy("season").agg(
        F.max(F.struct("_version", "_batch"))["_batch"].alias("_batch")
    )
    current = landed.join(F.broadcast(newest), ["season", "_batch"], "left_semi")
    record = current.select("season", "_version", F.posexplode_outer("records").alias("i", "record"))
    listed = record.select(
        "season", "_version", "i", F.posexplode_outer("record.teamRecords").alias("j", "t")
    )
    team = listed.select(
        "season",
        safe_int(F.col("t.team.id")).alias("team_id"),
        F.struct("_version", "i", "j").alias("place"),
        F.struct(
            safe_int(F.col("t.wins")).alias("wins"),
            safe_int(F.col("t.losses")).alias("losses"),
            safe_int(F.col("t.runsScored")).alias("runs_scored"),
            safe_int(F.col("t.runsAllowed")).alias("runs_allowed"),
        ).alias("line"),
    )
    dimension = teams(documents.sparkSession).select("team_id", F.col("feed_abbr").alias("team"))
    return (
        team.join(F.broadcast(dimension), "team_id")
        .groupBy("season", "team")
        .agg(F.max_by("line", F.struct("place", "line")).alias("line"))
        .select("season", "team", "line.*")
    )
