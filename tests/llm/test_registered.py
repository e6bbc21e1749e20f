"""The registered corpus queries: SQL where it can say them, and the pipeline's stages in order."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pitchlake.llm import queries
from tests.compare_engines import connection, spark_rows, sql_rows

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data here")


def test_all_are_registered():
    found = entry.queries()
    assert {k for k in found if k.startswith("op")} == set(queries.QUERIES)
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert found["pipeline"] is corpus_pipeline.run


@needs_data
@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_equals_sql(spark, key):
    assert spark_rows(queries.QUERIES[key](spark, DATA)) == sql_rows(connection(DATA), queries.ORACLES[key])


@needs_data
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = set(before)
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.written(stage(spark, frame, DATA), "stage")
        assert frame.columns == docs.columns, name
        now = {r["doc_id"] for r in frame.collect()}
        assert now <= kept and len(now) == frame.count()
        kept = now
    shorter = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert all(len(t) <= len(before[i]) for i, t in shorter.items())
    last = corpus_pipeline.STAGES[-1][1](spark, frame, DATA)
    rows = last.collect()
    assert {r["doc_id"] for r in rows} == kept and all(r["round_trip"] for r in rows)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, DATA).select("doc_id").collect()) == sorted(kept)
