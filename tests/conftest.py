from __future__ import annotations

import uuid

import pytest
from pyspark.sql import SparkSession

from pitchlake.operators.tables import TableName


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("pitchlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """A name in a database of its own."""
    database = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {database}")
    yield TableName("spark_catalog", database, "target")
    spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(frame):
        return sorted((tuple(r) for r in frame.collect()), key=repr)

    return collect
