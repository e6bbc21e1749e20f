"""Small pitch frames for tests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pitchlake.catalog.columns import SPARK_TYPES
from pitchlake.catalog.pitches import PITCHES

DEFAULTS = {
    "game_pk": 1, "game_date": date(2024, 5, 1), "game_year": 2024, "game_type": "R",
    "at_bat_number": 1, "pitch_number": 1, "batter": 10, "pitcher": 20, "inning": 1,
    "inning_topbot": "Top", "home_team": "DET", "away_team": "NYY",
}


def pitches(spark, *rows):
    """A full-width pitch frame; each row gives only what matters, the rest is default or null."""
    names = sorted({*DEFAULTS, *(k for r in rows for k in r)})
    schema = ", ".join(f"{n} {PITCHES[n].dtype}" for n in names)
    full = [tuple({**DEFAULTS, **r}.get(n) for n in names) for r in rows]
    frame = spark.createDataFrame(full, schema)
    return frame.select(*[
        F.col(c.name) if c.name in names else F.lit(None).cast(SPARK_TYPES[c.dtype]).alias(c.name)
        for c in PITCHES.columns
    ])
