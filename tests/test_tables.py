from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from pitchlake.catalog.games import GAMES, UMPIRES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.catalog.support import DICTIONARY
from pitchlake.operators.dictionary import apply_dictionary, documented_profile
from pitchlake.operators.tables import (
    TableName,
    apply_comments,
    create_table,
    partitions,
    replace_days,
    replace_key,
    replace_seasons,
    write_report,
)
from tests.helpers import pitches

MAY = (date(2024, 5, 1), date(2024, 5, 31))


def day(n, game):
    return {"game_date": date(2024, 5, n), "game_pk": game}


def content(spark, table):
    return sorted(
        (r.game_date.isoformat(), r.game_pk)
        for r in spark.table(str(table)).select("game_date", "game_pk").collect()
    )


def test_names():
    name = TableName.parse("c.d.t")
    assert str(name.sibling("u")) == "c.d.u"
    for bad in ("t", "d.t", "a.b.c.d", "a..t"):
        with pytest.raises(ValueError, match="catalog.database.table"):
            TableName.parse(bad)


def test_create_once_with_comments(spark, table):
    assert create_table(spark, table, PITCHES)
    assert not create_table(spark, table, PITCHES)
    fields = {f.name: f for f in spark.table(str(table)).schema.fields}
    assert set(fields) == set(PITCHES.names)
    assert fields["balls"].metadata["comment"] == PITCHES["balls"].description
    text = spark.sql(f"SHOW CREATE TABLE {table}").collect()[0][0]
    assert "PARTITIONED BY (game_date)" in text
    assert PITCHES.comment in text


def test_comments_of_an_older_table(spark, table):
    spark.sql(f"CREATE TABLE {table} (game_pk bigint, balls bigint COMMENT 'old') USING parquet")
    assert apply_comments(spark, table, PITCHES) == 2
    assert apply_comments(spark, table, PITCHES) == 0
    fields = {f.name: f for f in spark.table(str(table)).schema.fields}
    assert fields["balls"].metadata["comment"] == PITCHES["balls"].description


def test_replace_days(spark, table):
    create_table(spark, table, PITCHES)
    first = pitches(spark, day(1, 1), day(1, 1), day(2, 2), day(3, 3),
                    {"game_date": date(2024, 6, 1), "game_pk": 9})
    whole = (date(2024, 1, 1), date(2024, 12, 31))
    assert replace_days(first, table, PITCHES, *whole) == 5
    again = pitches(spark, day(2, 22), day(4, 4)).withColumn("miss_distance", F.lit(1.0))
    for _ in range(2):
        assert replace_days(again, table, PITCHES, *MAY) == 2
        assert content(spark, table) == [
            ("2024-05-02", 22), ("2024-05-04", 4), ("2024-06-01", 9),
        ]
    assert [p["game_date"] for p in partitions(spark, table)] == [
        "2024-05-02", "2024-05-04", "2024-06-01",
    ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_an_empty_batch_keeps_the_days(spark, table):
    create_table(spark, table, PITCHES)
    replace_days(pitches(spark, day(1, 1)), table, PITCHES, *MAY)
    assert replace_days(pitches(spark, day(1, 1)).where("false"), table, PITCHES, *MAY) == 0
    empty = spark.createDataFrame([], PITCHES.schema)
    assert replace_days(empty, table, PITCHES, *MAY) == 0
    assert content(spark, table) == [("2024-05-01", 1)]


@pytest.mark.parametrize("outside", [date(2024, 6, 1), None])
def test_rows_outside_the_days_are_refused(spark, table, outside):
    create_table(spark, table, PITCHES)
    replace_days(pitches(spark, day(1, 1)), table, PITCHES, *MAY)
    mixed = pitches(spark, day(2, 2), {"game_date": outside})
    with pytest.raises(Exception, match="outside the slice"):
        replace_days(mixed, table, PITCHES, *MAY)
    assert content(spark, table) == [("2024-05-01", 1)]


def test_a_day_too_big_for_one_task_is_split(spark, table):
    create_table(spark, table, PITCHES)
    big = spark.range(300000).select(
        F.col("id").alias("game_pk"), F.lit(MAY[0]).alias("game_date"),
        F.lit(2024).alias("game_year"), F.md5(F.col("id").cast("string")).alias("des"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assert replace_days(big, table, PITCHES, *MAY) == 300000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = spark.table(str(table)).select(F.input_file_name()).distinct().count()
    assert files > 1


def seasons(spark, *rows):
    return spark.createDataFrame(rows, "season bigint, game_pk bigint, game_date date")


def test_replace_seasons(spark, table):
    create_table(spark, table, GAMES)
    played = date(2024, 5, 1)
    first = seasons(spark, (2023, 1, played), (2024, 2, played), (2025, 3, played))
    assert replace_seasons(first, table, GAMES, [2023, 2024, 2025]) == 3
    assert replace_seasons(seasons(spark, (2024, 4, played)), table, GAMES, [2024, 2023]) == 1

    def found():
        return sorted(tuple(r) for r in spark.table(str(table)).select("season", "game_pk").collect())

    assert found() == [(2024, 4), (2025, 3)]
    assert replace_seasons(first, table, GAMES, []) == 0
    assert found() == [(2024, 4), (2025, 3)]
    assert replace_seasons(first.where("false"), table, GAMES, [2025, 2025]) == 0
    assert found() == [(2024, 4)]


def test_dictionary_slices(spark, table):
    create_table(spark, table, DICTIONARY)
    assert apply_dictionary(spark, table, PITCHES, "baseball", "pitches") == 118
    assert apply_dictionary(spark, table, GAMES, "baseball", "it's") == 26
    assert apply_dictionary(spark, table, PITCHES, "baseball", "pitches") == 118
    stored = spark.table(str(table))
    assert stored.count() == 144
    row = stored.where("`table` = 'pitches' AND `column` = 'balls'").collect()[0]
    assert row.tags == ["pitch_context"]
    assert row.business_definition.endswith("Between 0 and 3.")
    assert '"source_field": "balls"' in row.upstream_lineage_json
    assert row.created_at is not None
    with pytest.raises(ValueError, match="dataset"):
        replace_key(stored, table, DICTIONARY, dataset="baseball")


def test_documented_profile(spark):
    found = documented_profile(pitches(spark, day(1, 1), day(1, 2)), PITCHES, "b", "pitches")
    row = found.where("column_name = 'game_pk'").collect()[0]
    assert (row.non_null, row.min_value, row.max_value) == (2, "1", "2")
    assert row.description == PITCHES["game_pk"].description
    assert found.count() == 118


def test_report(spark, tmp_path):
    write_report(spark.range(3), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 3


def test_two_loads_in_threads_keep_each_others_days(spark, table):
    from concurrent.futures import ThreadPoolExecutor

    create_table(spark, table, UMPIRES)

    def load(day):
        rows = spark.createDataFrame([(day, date(2024, 5, day), "HP", 7, "A")], UMPIRES.schema)
        return replace_days(rows, table, UMPIRES, date(2024, 5, day), date(2024, 5, day))

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(load, range(1, 5))) == [1] * 4
    assert spark.table(str(table)).count() == 4
