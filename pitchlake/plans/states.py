"""Maintained partial states: what the long analyses need of each day, added up once and kept.

A state row holds sums and counts of one day and entity, or a quantile sketch, never a rate, so rows of any days
can be added. When days of the pitch table are replaced, the same days of every state are made anew from
them (``replace_days``), so a state always equals a scan, and a question over all seasons reads some
rows per day in place of every pitch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.catalog.columns import Column as TableColumn
from pitchlake.catalog.columns import TableLayout
from pitchlake.catalog.pitches import PITCHES
from pitchlake.functions import pitch as p
from pitchlake.operators import tables
from pitchlake.operators.tables import TableName, create_table
from pitchlake.plans import metrics

SKETCH_SIZE = 400
RANK_ERROR = 0.01  # of a quantile from sketches of that size, merged or not

_DAY = (
    TableColumn("game_date", "date", ("temporal", "partition_key"), "Day of the games.", required=True),
    TableColumn("game_year", "bigint", ("temporal",), "Season."),
)


def _sums(**described: tuple[str, str]) -> tuple[TableColumn, ...]:
    return tuple(TableColumn(name, kind, ("count",), text) for name, (kind, text) in described.items())


CONTACT_DAYS = TableLayout(
    columns=(*_DAY, *_sums(
        batted_balls=("bigint", "Batted balls with a speed."), barrels=("bigint", "Of these, barrels by speed and angle."),
        speed_sum=("double", "Sum of their speeds."),
    )),
    comment="Batted balls, one row per day and season.", partition_by=("game_date",), key=("game_date", "game_year"),
)
VELOCITY_DAYS = TableLayout(
    columns=(
        *_DAY, TableColumn("pitcher", "bigint", ("identifier",), "Pitcher."),
        TableColumn("pitch_type", "string", ("category",), "Kind of pitch."),
        *_sums(pitches=("bigint", "Pitches."), speeds=("bigint", "Pitches with a speed."), speed_sum=("double", "Sum of the speeds.")),
    ),
    comment="Pitch speeds, one row per day, pitcher and kind of pitch.", partition_by=("game_date",),
    cluster_by=("pitcher",), key=("game_date", "game_year", "pitcher", "pitch_type"),
)
SPIN_DAYS = TableLayout(
    columns=(
        *_DAY, TableColumn("pitch_type", "string", ("category",), "Kind of pitch."),
        *_sums(pitches=("bigint", "Pitches with a spin rate."), spin_sum=("bigint", "Sum of the spin rates."),
               sketch=("binary", "Quantile sketch of the spin rates.")),
    ),
    comment="Spin rates, one row per day and kind of pitch.", partition_by=("game_date",),
    key=("game_date", "game_year", "pitch_type"),
)
GAME_DAYS = TableLayout(
    columns=(
        *_DAY, TableColumn("pitcher", "bigint", ("identifier",), "Pitcher."),
        TableColumn("bucket", "bigint", ("identifier",), "Which range of game ids the bitmap is about."),
        *_sums(pitches=("bigint", "Pitches."), games=("binary", "Bitmap of the games, by place in the bucket.")),
    ),
    comment="Games pitched in, one row per day, pitcher and range of game ids.", partition_by=("game_date",),
    cluster_by=("pitcher",), key=("game_date", "game_year", "pitcher", "bucket"),
)


def _worth() -> Column:
    """Expected value on contact, actual value otherwise, times the weight of the plate appearance."""
    worth = F.when(
        F.col("description") == "hit_into_play", F.coalesce("estimated_woba_using_speedangle", F.lit(0.0))
    ).otherwise(F.coalesce("woba_value", F.lit(0.0)))
    return worth * F.col("woba_denom")


def _share(condition: Callable[[], Column]):
    return lambda keep: (F.count_if(keep & condition()).cast("double"), F.count_if(keep))


def _mean(name: str):
    return lambda keep: (F.sum(F.when(keep, F.col(name))).cast("double"), F.count_if(keep))


# Numerator and denominator of each batting metric; its sample is the denominator.
_HALVES: dict[str, Callable[[Column], tuple[Column, Column]]] = {
    "barrel_rate": _share(lambda: F.col("launch_speed_angle") == 6),
    "hard_hit_pct": _share(p.hard_hit),
    "avg_exit_velo": _mean("launch_speed"),
    "avg_launch_angle": _mean("launch_angle"),
    "xwoba_contact": lambda keep: (F.sum(F.when(keep, _worth())), F.sum(F.when(keep, F.col("woba_denom")))),
}
BATTER_DAYS = TableLayout(
    columns=(
        *_DAY, TableColumn("batter", "bigint", ("identifier",), "Batter."),
        *(c for name in _HALVES for c in _sums(**{
            f"{name}_kept": ("bigint", f"Pitches that count for {name}."),
            f"{name}_over": ("double", f"Numerator of {name}."),
            f"{name}_under": ("bigint", f"Denominator of {name}."),
        })),
    ),
    comment="Halves of the batting metrics, one row per day and batter.", partition_by=("game_date",),
    cluster_by=("batter",), key=("game_date", "game_year", "batter"),
)


def _regular(pitches: DataFrame) -> DataFrame:
    return pitches.where(p.regular_season())


def contact_days(pitches: DataFrame) -> DataFrame:
    return _regular(pitches).where(F.col("launch_speed").isNotNull()).groupBy("game_date", "game_year").agg(
        F.count("*").alias("batted_balls"), F.count_if(p.barrel_by_speed_and_angle()).alias("barrels"),
        F.sum("launch_speed").alias("speed_sum"),
    )


def velocity_days(pitches: DataFrame) -> DataFrame:
    kept = _regular(pitches).where(F.col("pitch_type").isNotNull())
    return kept.groupBy("game_date", "game_year", "pitcher", "pitch_type").agg(
        F.count("*").alias("pitches"), F.count("release_speed").alias("speeds"), F.sum("release_speed").alias("speed_sum")
    )


def spin_days(pitches: DataFrame) -> DataFrame:
    kept = _regular(pitches).where(F.col("release_spin_rate").isNotNull())
    return kept.groupBy("game_date", "game_year", "pitch_type").agg(
        F.count("*").alias("pitches"), F.sum("release_spin_rate").alias("spin_sum"),
        F.expr(f"kll_sketch_agg_bigint(release_spin_rate, {SKETCH_SIZE})").alias("sketch"),
    )


def batter_days(pitches: DataFrame) -> DataFrame:
    halves = []
    for name, made in _HALVES.items():
        keep = metrics.metric(name).keep()
        over, under = made(keep)
        halves += [F.count_if(keep).alias(f"{name}_kept"), over.alias(f"{name}_over"), under.alias(f"{name}_under")]
    return _regular(pitches).groupBy("game_date", "game_year", "batter").agg(*halves)


def game_days(pitches: DataFrame) -> DataFrame:
    """Outings are counted first, by hash; only these are sorted into bitmaps."""
    outings = _regular(pitches).groupBy("game_date", "game_year", "pitcher", "game_pk").agg(F.count("*").alias("n"))
    return outings.groupBy(
        "game_date", "game_year", "pitcher", F.bitmap_bucket_number("game_pk").alias("bucket")
    ).agg(
        F.sum("n").alias("pitches"), F.bitmap_construct_agg(F.bitmap_bit_position("game_pk")).alias("games"),
    )


@dataclass(frozen=True)
class StateTables:
    """Where the states are, in the pitch table's database, and which of them are kept."""

    pitches: TableName
    kept: tuple[str, ...] = ("contact_days", "velocity_days", "spin_days", "batter_days", "game_days")

    @property
    def made(self) -> list[tuple[TableName, TableLayout, Callable[[DataFrame], DataFrame]]]:
        return [
            (self.pitches.sibling(f"_{name}"), layout, make)
            for name, layout, make in (
                ("contact_days", CONTACT_DAYS, contact_days), ("velocity_days", VELOCITY_DAYS, velocity_days),
                ("spin_days", SPIN_DAYS, spin_days), ("batter_days", BATTER_DAYS, batter_days),
                ("game_days", GAME_DAYS, game_days),
            )
            if name in self.kept
        ]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(str(self.pitches.sibling(f"_{name}")))


def refresh(spark: SparkSession, states: StateTables, start: date, end: date) -> None:
    """Make the states of the days [start, end] from the pitch table; days without pitches lose theirs."""
    day = F.col("game_date").between(F.lit(start), F.lit(end))
    for name, layout, make in states.made:
        create_table(spark, name, layout)
        rows = make(spark.table(str(states.pitches)).where(day))
        tables.replace_days(rows, name, layout, start, end, keep_when_empty=False)


def replace_days(
    frame: DataFrame, states: StateTables, start: date, end: date, keep_when_empty: bool = True
) -> int:
    """Replace days of the pitch table, then of its states; returns the pitches written.

    A crash in between leaves states of the old days: running either again mends them.
    """
    written = tables.replace_days(frame, states.pitches, PITCHES, start, end, keep_when_empty=keep_when_empty)
    if written or not keep_when_empty:
        refresh(frame.sparkSession, states, start, end)
    return written


# Analyses from states. Each gives the rows of its namesake over the pitches.


def league_barrel_rate(days: DataFrame) -> DataFrame:
    return days.groupBy("game_year").agg(
        F.try_divide(F.sum("barrels"), F.sum("batted_balls")).alias("barrel_rate"),
        F.sum("batted_balls").alias("batted_balls"),
    ).orderBy("game_year")


def exit_velocity_by_season(days: DataFrame) -> DataFrame:
    return days.groupBy("game_year").agg(
        F.try_divide(F.sum("speed_sum"), F.sum("batted_balls")).alias("avg_ev"), F.sum("batted_balls").alias("bbe")
    ).orderBy("game_year")


def velocity_by_pitch_type(days: DataFrame, min_n: int = 50) -> DataFrame:
    return days.groupBy("pitcher", "pitch_type").agg(
        F.try_divide(F.sum("speed_sum"), F.sum("speeds")).alias("avg_velo"), F.sum("pitches").alias("pitches")
    ).where(F.col("pitches") >= min_n).orderBy("pitcher", F.desc("avg_velo"), "pitch_type")


def spin_distribution(days: DataFrame) -> DataFrame:
    """Mean spin exactly; median and 90th percentile within ``RANK_ERROR`` of the wanted rank."""
    merged = days.groupBy("pitch_type").agg(
        F.try_divide(F.sum("spin_sum"), F.sum("pitches")).alias("avg_spin"), F.sum("pitches").alias("pitches"),
        F.expr(f"kll_merge_agg_bigint(sketch, {SKETCH_SIZE})").alias("sketch"),
    )
    return merged.select(
        "pitch_type", "avg_spin", F.expr("kll_sketch_get_quantile_bigint(sketch, 0.5D)").alias("p50"),
        F.expr("kll_sketch_get_quantile_bigint(sketch, 0.9D)").alias("p90"), "pitches",
    ).orderBy(F.desc("avg_spin"), "pitch_type")


def pitch_tempo(days: DataFrame) -> DataFrame:
    """Pitches per game; a game that goes on on another day counts once, as its bit does."""
    merged = days.groupBy("pitcher", "bucket").agg(
        F.sum("pitches").alias("pitches"), F.bitmap_count(F.bitmap_or_agg("games")).alias("games")
    )
    return merged.groupBy("pitcher").agg(
        F.sum("pitches").alias("pitches"), F.sum("games").alias("games")
    ).withColumn("pitches_per_game", F.try_divide("pitches", "games")).orderBy(F.desc("pitches_per_game"), "pitcher")


def batting_metrics(
    days: DataFrame, season: int, names: Sequence[str] = tuple(_HALVES), min_n: int | None = None
) -> DataFrame:
    """Rows (metric, id, value, sample_size) of batting metrics of one season."""
    floor = metrics.MIN_SAMPLE["batter"] if min_n is None else min_n
    unknown = set(names) - set(_HALVES)
    if unknown:
        raise ValueError(f"no state for {sorted(unknown)}; choices: {list(_HALVES)}")
    totals = days.where(p.in_season(season)).groupBy(F.col("batter").alias("id")).agg(*[
        F.struct(
            F.lit(name).alias("metric"),
            F.try_divide(F.sum(f"{name}_over"), F.sum(f"{name}_under")).alias("value"),
            F.sum(f"{name}_under").alias("sample_size"), F.sum(f"{name}_kept").alias("kept"),
        ).alias(name)
        for name in names
    ])
    return (
        totals.select("id", F.inline(F.array(*[F.col(n) for n in names])))
        .where((F.col("kept") > 0) & (F.col("sample_size") >= floor))
        .select("metric", "id", "value", "sample_size")
    )
