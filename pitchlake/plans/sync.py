"""The load job: landed files into the pitch, umpire and game tables, with a run log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.catalog.games import GAMES, UMPIRES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.catalog.support import QUARANTINE, RUNS
from pitchlake.operators.conform import drift
from pitchlake.operators.runs import completed_chunks, pending, range_chunks, record_run
from pitchlake.operators.tables import TableName, create_table, replace_days, replace_seasons
from pitchlake.sources.documents import (
    crews_of, is_sound, kind_of, newest_of_each_season, officials, put_aside, schedule_games,
)
from pitchlake.sources.pitches import pitch_batch

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SyncTables:
    """Where the tables are; all but the pitches default to the pitch table's database."""

    pitches: TableName
    umpires: TableName
    games: TableName
    runs: TableName
    quarantine: TableName

    @classmethod
    def beside(cls, pitches: str, umpires: str | None = None, games: str | None = None,
               runs: str | None = None, quarantine: str | None = None) -> SyncTables:
        home = TableName.parse(pitches)

        def named(given: str | None, default: str) -> TableName:
            return TableName.parse(given) if given else home.sibling(default)

        return cls(home, named(umpires, "game_umpires"), named(games, "games"),
                   named(runs, "_ingest_runs"), named(quarantine, "_damaged_documents"))


def create_tables(
    spark: SparkSession, tables: SyncTables, location: str | None = None
) -> None:
    for name, layout in (
        (tables.pitches, PITCHES), (tables.umpires, UMPIRES),
        (tables.games, GAMES), (tables.runs, RUNS), (tables.quarantine, QUARANTINE),
    ):
        create_table(spark, name, layout, f"{location}/{name.table}" if location else None)


def _chunk_list(chunks: DataFrame) -> list[tuple[date, date]]:
    """At most one entry per month of the range, so it fits the driver by construction."""
    return [tuple(row) for row in chunks.orderBy("chunk_start").collect()]


def sync(
    spark: SparkSession,
    landed: DataFrame,
    tables: SyncTables,
    start: date,
    end: date,
    boxscores: DataFrame | None = None,
    schedules: DataFrame | None = None,
    chunk_kind: str = "year",
    resume: bool = False,
    dry_run: bool = False,
    whole_seasons: bool = False,
) -> list[tuple[date, date]]:
    """Load [start, end] chunk by chunk, then the schedules of its seasons; returns the chunks.

    Box scores are parsed once, before the first chunk. Only seasons that have a schedule document
    are replaced: by their games, and also, where ``schedules`` has a column ``season`` from the
    landing's folders, by a document without any game. The other seasons stay, with a warning. Damaged
    documents are put aside in a table of their own, with a warning, and replace nothing. With
    ``whole_seasons`` each schedule document is a whole season, named by that column: only the newest
    counts, and games that it no longer lists go.

    A chunk is one distributed write and the unit of logging and retry. A chunk without pitches
    is logged as empty and leaves the tables alone; a failure is logged and raised. Leave
    ``boxscores`` or ``schedules`` out to skip umpires or games.
    """
    if not dry_run:
        create_tables(spark, tables)
    todo = range_chunks(spark, start, end, chunk_kind)
    if resume and not dry_run:
        todo = pending(todo, completed_chunks(spark, tables.runs))
    chunks = _chunk_list(todo)
    if dry_run:
        return chunks

    unknown = drift(landed, PITCHES).unknown
    if unknown:
        log.warning("columns not in the pitch table are left out: %s", list(unknown))
    if boxscores is not None and chunks:
        with _staged(tables, boxscores) as documents, _staged(tables, officials(documents)) as crews:
            _put_aside(tables, documents)
            _load_chunks(spark, landed, tables, chunks, crews, chunk_kind)
    else:
        _load_chunks(spark, landed, tables, chunks, None, chunk_kind)
    if schedules is not None:
        with _staged(tables, schedules) as documents:
            _put_aside(tables, documents)
            _load_schedules(
                newest_of_each_season(documents) if whole_seasons else documents, tables,
                range(start.year, end.year + 1),
            )
    return chunks


@contextmanager
def _staged(tables: SyncTables, frame: DataFrame) -> Iterator[DataFrame]:
    """The frame from a table that lasts as long as the load, so that documents are parsed once."""
    spark = frame.sparkSession
    name = tables.runs.sibling(f"_staged_{uuid.uuid4().hex[:12]}")
    try:
        frame.write.format("parquet").saveAsTable(str(name))
        yield spark.table(str(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _put_aside(tables: SyncTables, documents: DataFrame) -> None:
    found = put_aside(documents, tables.quarantine)
    if found:
        log.warning("damaged %s documents put aside in %s: %s", kind_of(documents), tables.quarantine, found)


def _load_chunks(
    spark: SparkSession, landed: DataFrame, tables: SyncTables, chunks: list[tuple[date, date]],
    crews: DataFrame | None, chunk_kind: str,
) -> None:
    for first, last in chunks:
        began = datetime.now(UTC)
        try:
            written = replace_days(
                pitch_batch(landed, first, last), tables.pitches, PITCHES, first, last
            )
            if written and crews is not None:
                # The games come from what was just written, not from the landed files again.
                loaded = spark.table(str(tables.pitches)).where(
                    F.col("game_date").between(F.lit(first), F.lit(last))
                )
                replace_days(
                    crews_of(loaded, crews), tables.umpires, UMPIRES, first, last
                )
        except Exception as error:
            record_run(spark, tables.runs, first, last, chunk_kind, "failed", 0, began, str(error))
            raise
        status = "success" if written else "empty"
        record_run(spark, tables.runs, first, last, chunk_kind, status, written, began)


def _load_schedules(schedules: DataFrame, tables: SyncTables, seasons: range) -> None:
    games = schedule_games(schedules)
    # At most one row per season, with how many of its games have no season of their own.
    found = {r["season"]: r["n"] for r in games.groupBy("season").agg(F.count("*").alias("n")).collect()}
    if found.get(0):
        log.warning("games without a readable season are left out: %d", found[0])
    landed = set(found)
    if "season" in schedules.columns:
        sound = schedules.where(is_sound(schedules))
        named = sound.select(F.col("season").cast("int").alias("season")).distinct()
        landed |= {r["season"] for r in named.collect()}
    present = [s for s in seasons if s in landed]
    missing = [s for s in seasons if s not in landed]
    if not present:
        # Without this, a failed download would empty the seasons.
        raise ValueError(f"no schedule documents for seasons {missing}")
    if missing:
        log.warning("no schedule documents for seasons %s; their games stay as they are", missing)
    replace_seasons(games.where(F.col("season").isin(present)), tables.games, GAMES, present)
