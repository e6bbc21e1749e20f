"""WARC archives written and read by Spark alone; records found by boundary-chain verification.

Writing is a text table of whole records. Reading splits the files at every occurrence of the magic
line, wherever tasks happen to begin, so that each candidate record knows its offset and, from its
header, the offset of its successor. Pointer jumping from the start of each file then keeps exactly
the candidates on the chain: a magic line inside a payload is never reached. A record whose payload
holds the magic is put together again from its pieces.

Defined results
    Null html: empty payload. Null url: no target header. Null page_id: always a response, id null.
    Repeated pages: each a record; rows with the smallest id of their payload are all responses.
    Payloads shorter than ``revisit_bytes`` are always responses. A truncated last record and whatever
    follows a broken link of the chain are not returned. No rows: no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.llm.store import new_folder, written

VERSION = "WARC/1.1"
MAGIC = f"{VERSION}\r\n"
GAP = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: five bits a letter, eight letters from ten hex digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, revisit_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A column ``value`` with a whole record for each page, without the gap behind it."""
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"),
    )
    rows = rows.withColumns({
        "bytes": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload").cast("binary")),
    })
    rows = rows.join(_revisits(rows.select("page_id", "bytes", "digest"), revisit_bytes), ["page_id", "digest"], "left")
    rows = rows.withColumn("again", F.col("first").isNotNull())
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(GAP),
    )
    block = F.when(F.col("again"), http).otherwise(F.concat(http, "payload"))
    size = F.octet_length(http) + F.when(F.col("again"), 0).otherwise(F.col("bytes"))
    revisit = F.when(F.col("again"), _urn(F.col("first")))
    return rows.select(F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]+", "%20")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))),
        _line("WARC-Refers-To", revisit),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", size.cast("string")),
        F.lit("\r\n"), block,
    ).alias("value"))


def _revisits(rows: DataFrame, revisit_bytes: int) -> DataFrame:
    """(page_id, digest, first) of the pages that repeat the payload of a smaller id.

    Written before the pages are joined with it: they are then shuffled only if these are many.
    """
    shared = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first <> last")
    shared = written(shared.select("digest", "first"), "warc-shared")
    again = rows.where(F.col("bytes") >= revisit_bytes).join(shared, "digest").where("page_id <> first")
    return written(again.select("page_id", "digest", "first").distinct(), "warc-revisits")


def write_archives(pages: DataFrame, folder: str, **options) -> None:
    """WARC files of all pages in ``folder``."""
    records(pages, **options).write.option("lineSep", GAP).option("compression", "none").text(folder)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between two magic lines, in order of ``seq`` within a file."""
    return (
        spark.read.option("lineSep", MAGIC).text(folder)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("seq"), "value",
        )
    )


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.nullif(F.trim(found), F.lit(""))


def _parsed(frame: DataFrame) -> DataFrame:
    """Header fields of each candidate, and its payload's length and digest as far as it is whole."""
    header = F.substring_index("value", GAP, 1)
    http = F.substring_index("value", GAP, 2)
    whole = frame.withColumns({"size": F.octet_length("value").cast("long"), "header": header})
    whole = whole.withColumns({
        "head_bytes": F.octet_length("header").cast("long") + len(GAP),
        "length": _field(F.col("header"), "Content-Length").try_cast("bigint"),
    })
    whole = whole.withColumns({
        "length": F.when((F.col("head_bytes") <= F.col("size")) & (F.col("length") >= 0), F.col("length")),
        "is_http": F.coalesce(_field(F.col("header"), "Content-Type").startswith("application/http"), F.lit(False)),
    })
    # In an HTTP block the payload follows the block's own header.
    payload_at = F.when(F.col("is_http"), F.octet_length(http).cast("long") + len(GAP)).otherwise(F.col("head_bytes"))
    whole = whole.withColumn("payload_at", F.least(payload_at, F.col("head_bytes") + F.col("length")))
    payload_size = F.col("head_bytes") + F.col("length") - F.col("payload_at")
    payload = F.substring(F.col("value").cast("binary"), F.col("payload_at").cast("int") + 1, payload_size.cast("int"))
    complete = F.col("size") >= F.col("head_bytes") + F.col("length")
    return whole.select(
        *[c for c in frame.columns if c != "value"], "size",
        (F.col("head_bytes") + F.col("length")).alias("needs"),
        F.coalesce(complete, F.lit(False)).alias("complete"),
        _field(F.col("header"), "WARC-Type").alias("record_type"),
        _field(F.col("header"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("header"), "WARC-Target-URI").alias("target_uri"),
        _field(F.col("header"), "WARC-Refers-To").alias("refers_to"),
        F.regexp_extract(F.coalesce(_field(F.col("header"), "WARC-Payload-Digest"), F.lit("")), "sha1:(.*)", 1).alias("stated_digest"),
        F.when(complete, payload_size).alias("stored_bytes"),
        F.when(complete, base32_sha1(payload)).alias("stored_digest"),
        F.when(F.col("is_http"), _last_length(http)).alias("http_length"),
    )


def _last_length(http: Column) -> Column:
    """Content-Length of the HTTP header: the part behind the record's own header."""
    return _field(F.substring_index(http, GAP, -1), "Content-Length").try_cast("bigint")


def reachable(nodes: DataFrame) -> DataFrame:
    """(file, at) of the nodes (file, at, next) that the chain from offset 0 of their file reaches.

    Each round doubles the length of all jumps and marks what the marked nodes jump to, so a chain of
    n records takes about log2(n) rounds.
    """
    state = nodes.select("file", "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("reached"))
    while True:
        state = written(state, "warc-chain")
        if state.where("jump IS NOT NULL").isEmpty():
            return state.where("reached").select("file", "at")
        to = state.select("file", F.col("at").alias("jump"), F.col("jump").alias("further"))
        joined = state.join(to.withColumn("there", F.lit(True)), ["file", "jump"], "left")
        own = F.struct(F.col("at"), F.col("further").alias("jump"), F.col("reached"))
        target = F.struct(
            F.when(F.col("there") & F.col("reached"), F.col("jump")).alias("at"),
            F.lit(None).cast("long").alias("jump"), F.lit(True).alias("reached"),
        )
        state = (
            joined.select("file", F.inline(F.array(own, target))).where("at IS NOT NULL")
            .groupBy("file", "at").agg(F.max("jump").alias("jump"), F.max("reached").alias("reached"))
        )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record on the chain of its file, in no order.

    file, at, record_type, record_id, target_uri, refers_to, payload_bytes and payload_digest (of
    revisits as their headers state them), and whether a stored payload has the stated digest.
    """
    mark = len(MAGIC)
    order = Window.partitionBy("file").orderBy("split", "seq")
    before = F.sum(F.col("size") + mark).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # The first piece of a file is what stands before its first magic line.
    found = _parsed(_pieces(spark, folder)).withColumn("at", F.coalesce(before, F.lit(0)) - mark)
    found = written(found, "warc-candidates")
    nodes = found.where("at >= 0 AND needs IS NOT NULL").select(
        "file", "at", (F.col("at") + mark + F.col("needs") + len(GAP)).alias("next")
    )
    kept = reachable(nodes)
    on_chain = found.join(kept, ["file", "at"])
    whole = on_chain.where("complete")
    broken = on_chain.where("NOT complete").select("file", "at", "needs")
    if not broken.isEmpty():
        whole = whole.unionByName(_rejoined(spark, folder, found, kept, broken))
    stored = F.col("record_type") != "revisit"
    return whole.select(
        "file", "at", "record_type", "record_id", "target_uri", "refers_to",
        F.when(stored, F.col("stored_bytes")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(stored, F.col("stored_digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        (~stored | (F.col("stored_digest") == F.col("stated_digest"))).alias("intact"),
    )


def _rejoined(spark: SparkSession, folder: str, found: DataFrame, kept: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds the magic, from all their pieces. A record is one cell, so they fit."""
    marked = found.select("file", "split", "seq", "at", "size").join(kept.withColumn("start", F.col("at")), ["file", "at"], "left")
    order = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = marked.withColumn("start", F.last("start", ignorenulls=True).over(order))
    wanted = owned.join(broken.select("file", F.col("at").alias("start")), ["file", "start"], "left_semi")
    same = F.when(F.octet_length("value") == F.col("size"), F.col("value")).otherwise(
        F.raise_error(F.lit("an archive changed while it was read")).cast("string")
    )
    pieces = _pieces(spark, folder).drop("split").join(wanted, ["file", "seq"])
    joined = pieces.select("file", "start", F.struct("at", same.alias("value")).alias("piece")).groupBy("file", "start").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["value"]), MAGIC).alias("value")
    )
    rows = joined.select(
        "file", F.lit(0).cast("long").alias("split"), F.lit(0).cast("long").alias("seq"), "value",
        F.col("start").alias("at"),
    )
    return _parsed(rows).where("complete").select(*found.columns)


def warc_round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as the archives of all pages tell."""
    folder = folder or new_folder(spark, "warc")
    write_archives(pages, folder, **options)
    kind = pages.schema[options.get("page_id", "page_id")].dataType.simpleString()

    def page(urn: str) -> Column:
        text = F.regexp_extract(urn, "^<urn:page:(.*)>$", 1)
        return F.when(text != "null", text).cast(kind)

    return read_archives(spark, folder).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"), "intact",
    )
