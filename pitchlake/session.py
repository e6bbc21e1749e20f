"""A Spark session with the settings the jobs are designed for."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

HUGE_METHOD = 8000  # bytes of code in a method that HotSpot still compiles


class _Writers:
    """How many writes of a session are running, and its setting before the first of them."""

    def __init__(self) -> None:
        self.lock, self.running, self.before = threading.Lock(), 0, ""


_WRITERS = _Writers()


@contextmanager
def compiled_rows(spark: SparkSession) -> Iterator[None]:
    """While wide rows are written, their columns are made in methods that the JVM compiles.

    Spark puts all columns of a frame into one method, and one beyond ``HUGE_METHOD`` bytes is interpreted,
    some ten times slower. With the limit set Spark gives the columns methods of their own there. Writes of
    several threads of a driver share the setting; after the last it is as it was.
    """
    setting = "spark.sql.codegen.hugeMethodLimit"
    with _WRITERS.lock:
        if not _WRITERS.running:
            _WRITERS.before = spark.conf.get(setting)
            spark.conf.set(setting, str(min(HUGE_METHOD, int(_WRITERS.before))))
        _WRITERS.running += 1
    try:
        yield
    finally:
        with _WRITERS.lock:
            _WRITERS.running -= 1
            if not _WRITERS.running:
                spark.conf.set(setting, _WRITERS.before)


def builder(
    app: str = "pitchlake", shuffle_partitions: int | None = None, partition_size: str = "256m"
) -> SparkSession.Builder:
    """Session settings; give the master, memory and cluster options on top.

    ``shuffle_partitions`` is the number of partitions before adaptive execution merges small
    ones: a few per core, and enough that one holds a few hundred megabytes of the largest
    shuffle. A load shuffles the whole batch once; the analyses shuffle far less than they read.
    ``partition_size`` is what adaptive execution merges or splits to, so it is also about the data
    behind one written file. A load with less data than that per core is written by fewer tasks
    than there are cores; choose it smaller there.
    """
    made = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", partition_size)
        .config("spark.sql.files.maxPartitionBytes", "256m")
    )
    if shuffle_partitions:
        made = made.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return made
