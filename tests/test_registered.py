"""Every registered query equals its SQL, on the given tables and on tables with one hot key."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks import registry
from checks.oracles import ORACLES
from tests.compare_engines import connection, spark_rows, sql_rows

DATA = "/root/testdata/sf0.001"
QUERIES = registry.all_queries()
SQL = ORACLES
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data here")
# Tables are written, and metrics computed one by one, on the given tables only; the rest, among
# them all metrics from one scan, also with a hot key.
GIVEN_ONLY = {
    "t_replace_days", "t_replace_seasons", "t_dictionary", "t_pruned_scan", "src_schedule_seasons",
    "src_leaderboard_file", "v_results_json", "r_sync_tables", "v_report_json",
    "s_wins", "s_losses", "t_replace_atomic", "t_comments", "src_damaged_documents", "src_landing_manifest", "t_z_order",
    "st_season_lines", "st_velocity", "st_batting_metrics", "st_spin", "r_daily_feed",
    "st_pitch_tempo", "t_by_game", "t_point_lookup",
} | {key for key in QUERIES if key.startswith("m_") and not key.endswith("_all")}


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@needs_data
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, key):
    assert spark_rows(QUERIES[key](spark, DATA)) == sql_rows(connection(DATA), SQL[key])


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    """The given tables, where a third of all pitches belongs to one plate appearance."""
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for name in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    # Order 150 is in game 2, a regular-season game of 2024.
    con.execute(f"""
        COPY (SELECT * FROM lineitem UNION ALL
              SELECT * REPLACE (150 AS l_orderkey) FROM lineitem WHERE l_partkey % 2 = 0)
        TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    con.execute(f"COPY orders TO '{folder}/orders.parquet' (FORMAT parquet)")
    return str(folder)


@needs_data
@pytest.mark.parametrize("key", sorted(set(QUERIES) - GIVEN_ONLY))
def test_query_equals_sql_with_a_hot_key(spark, hot, key):
    assert spark_rows(QUERIES[key](spark, hot)) == sql_rows(connection(hot), SQL[key])


@needs_data
def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert "barrel_rate" in frame.columns


def test_entry_without_the_corpus_part(tmp_path):
    """The entry imports and lists this library's queries where the corpus folders are gone, the pipeline's file or not."""
    root = Path(entry.__file__).resolve().parent
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    for name in ("checks", "pitchlake"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(QUERIES)), "True"]
