"""Queries of the operators over the given tables, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import (
    decontaminate, jaccard, language, phrases, pieces, quality, recurrent, suffixes, topk, toxicity, urlfilter, warc, whitening,
)
from pitchlake.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.lm_scores(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(spark, table(spark, sf_dir, "pages")).drop("intact")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its number of pieces, their digest, and whether they decode to the text."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(rows, checked="round_trip", keep_text=False)
    return found.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"), "round_trip"
    )


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


URL_RULES = [
    (urlfilter.BLOCK, "net/"), (urlfilter.ALLOW, "example.net/en/"),
    (urlfilter.BLOCK, "example.com/de/"), (urlfilter.ALLOW, "org/fr/"),
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rules_frame(spark, URL_RULES))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_lm_score": op1_lm_score,
    "op2_language": op2_language,
    "op3_warc": op3_warc,
    "op4_pieces": op4_pieces,
    "op5_toxicity": op5_toxicity,
    "op6_suffixes": op6_suffixes,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_jaccard": op10_jaccard,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_phrases": op13_phrases,
}

ORACLES: dict[str, str] = {
    "op3_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
        ), told AS (
            SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
                   list_aggregate([
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                           ((('0x' || substr(digest, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)
                       FOR i IN range(32)], 'string_agg', '') AS payload_digest,
                   min(page_id) OVER (PARTITION BY digest) AS first
            FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM told""",
    "op9_exact_top_k": """
        WITH usable AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_inner_product(q.v, c.v)::BIGINT AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
                AS "rank"
            FROM scored
        )
        SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5""",
    "op11_url_filter": """
        WITH rules(host, path, verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), rests AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages
        ), hosts AS (
            SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
        ), split AS (
            SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM hosts
        )
        SELECT s.page_id, s.host, s.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
               coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
        FROM split s LEFT JOIN rules r
            ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
        GROUP BY ALL""",
    "op13_phrases": """
        WITH pieces AS (
            SELECT row_number() OVER () AS piece, lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS said
            FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)
        ), words AS (
            SELECT lang, regexp_extract_all(said, '[^\x20\x09]+') AS w FROM pieces
        ), totals AS (
            SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
        ), runs AS (
            SELECT lang, list_slice(w, i, i + k - 1) AS p
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS k FROM words) WHERE len(w) >= k)
        ), counts AS (
            SELECT lang, p, count(*) AS f FROM runs GROUP BY lang, p HAVING count(*) >= 100
        ), cuts AS (
            SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM counts WHERE len(p) > 1
        ), marked AS (
            SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, n,
                   (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
            FROM cuts c JOIN totals USING (lang)
            JOIN counts x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, c.k)
            JOIN counts y ON y.lang = c.lang AND y.p = list_slice(c.p, c.k + 1, len(c.p))
        ), best AS (
            SELECT * FROM marked QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, list_slice(p, i, i + k - 1) AS p, max(f) AS longer
            FROM (SELECT lang, p, f, k, unnest(range(1, len(p) - k + 2)) AS i
                  FROM (SELECT lang, p, f, unnest(range(2, len(p))) AS k FROM counts WHERE len(p) > 2))
            GROUP BY ALL
        ), kept AS (
            SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.p = b.p
            WHERE longer IS NULL OR 100 * longer < 100 * a
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank" FROM kept
        )
        SELECT lang, "rank"::BIGINT AS "rank", phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
        FROM placed WHERE "rank" <= 2000""",
}
