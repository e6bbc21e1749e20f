"""URL filters by a sort-merge range join.

A host becomes a canonical key, its labels reversed and each closed by a slash (``a.example.net`` gives
``net/example/a/``; no host holds a slash). A rule's host and all its subdomains are then one interval
of keys, those that start with the rule's key, and two intervals are nested or apart. URLs are cut into
ranges of keys of about equal size, a very common host into several; a rule goes to the ranges that its
interval meets. Each range is sorted and swept once: a stack holds the rules of the hosts that are open
at the current key, on each level sorted by path and linked to the next shorter path that is a prefix, so
the longest fitting path is found by one search and a walk along links.

A task holds a batch of URLs and the rules of the hosts on the stack. A rule is copied to each range its
host spans, so copies grow with rules times ranges at most. The cuts come from a sample of about
``SAMPLE`` keys a range, shortened to ``CUT`` characters; they decide where a row is judged, never how.

Defined results
    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; path: from there up
    to ``?``, ``#`` or the end. A null url, or one without ``://``: both empty. A rule fits if its host is
    the url's or a parent of it and the url's path starts with the rule's. The longest fitting rule wins
    (host and path together); of two equally long ones that with the longer host; of a rule given with
    both verdicts ``block``. Without a fitting rule: the default, ``allow``. Rules without host, path or
    verdict are ignored; an empty rule host fits urls without host and hosts that end in a dot.
    Rows are judged one by one: repeated rows and null ids stay. No rows: no rows. Further columns of
    ``judge`` are ignored, those of ``keep_allowed`` are kept.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
SAMPLE = 16
CUT = 256
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def canonical(host: Column) -> Column:
    """Reversed labels, each followed by a slash."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))


def host_of(key: str) -> str:
    return ".".join(reversed(key[:-1].split("/")))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules given as (verdict, ``host/path``) as a frame (host, path, verdict)."""
    rows = []
    for verdict, text in rules:
        host, slash, path = text.partition("/")
        rows.append((host, slash + path, verdict))
    return spark.createDataFrame(rows, "host string, path string, verdict string")


class Level:
    """The rules of one host, sorted by path; each knows the next shorter path that is its prefix."""

    def __init__(self, key: str, rules: list[tuple[str, str]]):
        self.key = key
        self.host = host_of(key)
        kept: dict[str, str] = {}
        for path, verdict in sorted(rules):
            if kept.get(path) != BLOCK:
                kept[path] = verdict
        self.paths = sorted(kept)
        self.verdicts = [kept[p] for p in self.paths]
        self.outer: list[int] = []
        for i, path in enumerate(self.paths):
            j = i - 1
            while j >= 0 and not path.startswith(self.paths[j]):
                j = self.outer[j]
            self.outer.append(j)

    def longest(self, path: str) -> int:
        """Index of the longest rule path that ``path`` starts with, or -1."""
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.outer[i]
        return i


class Sweep:
    """Rules and urls in order of their keys, rules first; a stack of levels whose hosts are open."""

    def __init__(self, default: str):
        self.default = default
        self.reset()

    def reset(self) -> None:
        self.stack: list[Level] = []
        self.waiting: list[tuple[str, str]] = []
        self.key: str | None = None
        self.host = ""

    def move(self, key: str) -> None:
        """Go on to ``key``: rules gathered so far become a level, levels that ended are closed."""
        if self.waiting:
            self.stack.append(Level(self.key, self.waiting))
            self.waiting = []
        if key != self.key:
            while self.stack and not key.startswith(self.stack[-1].key):
                self.stack.pop()
            self.key, self.host = key, host_of(key)

    def rule(self, key: str, path: str, verdict: str) -> None:
        if key != self.key:
            self.move(key)
        self.waiting.append((path, verdict))

    def url(self, key: str, path: str) -> tuple[str | None, str]:
        if key != self.key or self.waiting:
            self.move(key)
        best, found = (-1, -1), (None, self.default)
        for level in self.stack:
            i = level.longest(path)
            if i >= 0:
                size = (len(level.host) + len(level.paths[i]), len(level.host))
                if size > best:
                    best, found = size, (level.host + level.paths[i], level.verdicts[i])
        return found


def _cuts(places: DataFrame, parts: int) -> list[tuple[str, int]]:
    """Up to ``parts`` - 1 (key, salt) that cut the rows into ranges of about equal size."""
    total = places.count()
    wanted = SAMPLE * parts
    if total > wanted:
        places = places.sample(fraction=wanted / total, seed=11)
    seen = sorted((r["k"].encode(), r["s"]) for r in places.select(F.left("key", F.lit(CUT)).alias("k"), F.col("salt").alias("s")).collect())
    cuts = [seen[i * len(seen) // parts] for i in range(1, parts)] if seen else []
    return sorted(set(cuts))


def _deal(cuts):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = cuts.value
        for batch in batches:
            keys, salts = batch.column("key").to_pylist(), batch.column("salt").to_pylist()
            part = [bisect_right(held, (k[:CUT].encode(), s)) for k, s in zip(keys, salts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), batch.column("key"), pa.array([1] * len(part), pa.int32()),
                 batch.column("path"), pa.nulls(len(part), pa.string()), batch.column("id")],
                ["part", "key", "kind", "path", "verdict", "id"],
            )

    return deal


def _spread(cuts):
    """A copy of each rule for every range that its interval of keys meets."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = cuts.value
        for batch in batches:
            for key, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("key", "path", "verdict")), strict=True):
                # All keys that start with this one lie before the same key with its last slash raised.
                first = bisect_left(held, (key[:CUT].encode(), _LEAST))
                last = bisect_right(held, ((key[:-1] + "0")[:CUT].encode(), _MOST))
                part = pa.array(range(first, last + 1), pa.int32())
                same = [pa.repeat(pa.scalar(x, pa.string()), len(part)) for x in (key, path, verdict)]
                yield pa.RecordBatch.from_arrays(
                    [part, same[0], pa.repeat(pa.scalar(0, pa.int32()), len(part)), same[1], same[2]],
                    ["part", "key", "kind", "path", "verdict"],
                )

    return spread


def _judged(default: str):
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, current = Sweep(default), None
        for batch in batches:
            parts, keys, kinds, paths, verdicts = (
                batch.column(c).to_pylist() for c in ("part", "key", "kind", "path", "verdict")
            )
            at, hosts, rules, said = [], [], [], []
            for i, (part, key, kind, path) in enumerate(zip(parts, keys, kinds, paths, strict=True)):
                if part != current:
                    sweep.reset()
                    current = part
                if kind == 0:
                    sweep.rule(key, path, verdicts[i])
                    continue
                rule, verdict = sweep.url(key, path)
                at.append(i)
                hosts.append(sweep.host)
                rules.append(rule)
                said.append(verdict)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(rows), pa.array(hosts, pa.string()), batch.column("path").take(rows),
                 pa.array(rules, pa.string()), pa.array(said, pa.string())],
                ["id", "host", "path", "rule", "verdict"],
            )

    return judged


def judge(
    urls: DataFrame, rules: DataFrame, default: str = ALLOW, row_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """(row_id, host, path, rule, verdict) of every row; rules are (host, path, verdict)."""
    spark = urls.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    host, path = host_and_path(F.col("u"))
    rows = urls.select(F.col(row_id).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("u"))
    rows = rows.select("id", canonical(host).alias("key"), path.alias("path")).withColumn(
        "salt", F.xxhash64("path", "id")
    )
    kind = rows.schema["id"].dataType.simpleString()
    cuts = spark.sparkContext.broadcast(_cuts(rows, parts))
    given = rules.select(
        canonical(F.translate("host", _UPPER, _UPPER.lower())).alias("key"), "path", "verdict"
    ).where("key IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").distinct()
    columns = "part int, key string, kind int, path string, verdict string"
    dealt = rows.mapInArrow(_deal(cuts), f"{columns}, id {kind}").unionByName(
        given.mapInArrow(_spread(cuts), columns), allowMissingColumns=True
    )
    ordered = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "kind", "path")
    found = ordered.mapInArrow(
        _judged(default), f"id {kind}, host string, path string, rule string, verdict string"
    )
    return found.withColumnRenamed("id", row_id)


def keep_allowed(pages: DataFrame, rules: DataFrame, default: str = ALLOW, url: str = "url") -> DataFrame:
    """The rows of ``pages``, all their columns, whose url is not blocked. Each distinct url is judged once."""
    distinct = pages.select(F.col(url).alias("_url")).distinct()
    blocked = judge(distinct, rules, default, "_url", "_url").where(F.col("verdict") == BLOCK).select("_url")
    return pages.join(blocked, pages[url].eqNullSafe(blocked["_url"]), "left_anti")
