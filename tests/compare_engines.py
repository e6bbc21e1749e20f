"""Run a registered query and its SQL over the same parquet files and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connection(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return (str(type(value)), str(value))
    if isinstance(value, (int, float)):
        return ("number", "nan" if math.isnan(value) else repr(round(float(value), 6) + 0.0))
    return ("text", str(value))


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(_cell(r[n]) for n in names) for r in frame.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    given = [d[0] for d in cursor.description]
    names = sorted(given)
    return names, sorted(
        tuple(_cell(dict(zip(given, r, strict=True))[n]) for n in names) for r in cursor.fetchall()
    )
