"""Z-order: ranks, interleaving, and how many row groups a filter on one column has to read."""

from __future__ import annotations

import random
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pitchlake.catalog.pitches import PITCHES
from pitchlake.operators import cluster
from pitchlake.operators.tables import TableName, create_table, replace_days
from tests.helpers import pitches

DAY = date(2024, 5, 1)
COLUMNS = ("away_team", "game_pk")


def interleaved(ranks, bits):
    return sum(((r >> b) & 1) << (b * len(ranks) + len(ranks) - 1 - i) for i, r in enumerate(ranks) for b in range(bits))


def test_ranks_are_interleaved(spark):
    rows = [(i, f"t{i % 5}é", float(i % 7) if i % 11 else None, date(2024, 1, 1 + i % 9)) for i in range(200)]
    frame = spark.createDataFrame(rows, "a long, b string, c double, d date")
    names = ["a", "b", "c", "d"]
    bounds = cluster.quantile_bounds(frame, names, 3)
    assert all(len(v) <= 7 and v == sorted(set(v)) for v in bounds.values())

    def number(value):
        if isinstance(value, str):
            return int(value.encode()[:7].hex().ljust(14, "0"), 16)
        return (value - date(1970, 1, 1)).days if isinstance(value, date) else value

    def rank(name, value):
        return 0 if value is None else sum(number(value) > b for b in bounds[name])

    found = frame.withColumn("z", cluster.z_value(frame, names, 3)).collect()
    assert len({r.z for r in found}) > 20
    assert all(r.z == interleaved([rank(n, r[n]) for n in names], 3) for r in found)
    with pytest.raises(ValueError, match="do not fit"):
        cluster.z_value(frame, names, 16)
    with pytest.raises(ValueError, match="no order"):
        cluster.z_value(frame.select(F.array("a").alias("x")), ["x"])
    assert cluster.quantile_bounds(frame.where("false"), ["a"], 2) == {"a": []}


def read_groups(folder, column, value):
    """Row groups whose bounds hold the value, and all of them."""
    found = every = 0
    for file in Path(folder).glob("**/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(at).statistics
            every += 1
            found += stats.min <= value <= stats.max
    return found, every


def test_a_filter_on_one_column_reads_half_the_row_groups_of_the_linear_sort(spark, table, tmp_path):
    rng = random.Random(1)
    teams = [f"T{i:02}" for i in range(30)]
    rows = [
        {"game_date": DAY, "home_team": rng.choice(teams), "away_team": rng.choice(teams), "game_pk": rng.randint(1, 10_000), "at_bat_number": i}
        for i in range(30_000)
    ]
    frame = pitches(spark, *rows)
    settings = {"parquet.block.size": "65536", "parquet.page.size.row.check.min": "50", "parquet.page.size.row.check.max": "200"}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = {k: conf.get(k) for k in settings}
    made = {}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        for kind, z in (("linear", ()), ("z", COLUMNS)):
            name = TableName(table.catalog, table.database, kind)
            create_table(spark, name, PITCHES, str(tmp_path / kind))
            replace_days(frame.coalesce(1), name, PITCHES, DAY, DAY, z_order=z)
            made[kind] = spark.table(str(name))
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    for column, value in (("away_team", "T07"), ("away_team", "T21"), ("game_pk", 5000), ("game_pk", 77)):
        linear, every = read_groups(tmp_path / "linear", column, value)
        z, also = read_groups(tmp_path / "z", column, value)
        assert every > 20 and also > 20
        assert z / also <= 0.5 * linear / every, (column, z, also, linear, every)
        wanted = sorted(r["at_bat_number"] for r in rows if r[column] == value)
        for kind in made:
            assert sorted(r.at_bat_number for r in made[kind].where(F.col(column) == value).select("at_bat_number").collect()) == wanted
