"""URL rules, whitening and phrases: against plain loops over small tables with every kind of odd row."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from pitchlake.llm import phrases, urlfilter, whitening

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
    # Names that the operator uses inside or returns.
    T.StructField("key", T.StringType()), T.StructField("verdict", T.LongType()), T.StructField("part", T.StringType()),
])
RULES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "a.b.org/fr/x"),
    ("allow", "a.b.org/fr/x"), ("block", "org/fr/x/longer/path"), ("allow", "com"), ("block", "/"), ("block", "Xn--p1.COM/ä"), ("allow", "."),
]


def judged_plainly(url, rules):
    rest = url[url.index("://") + 3:] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    fits = []
    for verdict, text in rules:
        name, slash, end = text.partition("/")
        name, end = "".join(c.lower() if "A" <= c <= "Z" else c for c in name), slash + end
        if (host == name or host.endswith("." + name)) and path.startswith(end):
            fits.append((len(name + end), len(name), verdict == "block", name + end, verdict))
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def urls() -> list[tuple]:
    rng = random.Random(3)
    hosts = ["net", "EXAMPLE.net", "a.example.net", "notexample.net", "x.example.com", "b.org", "a.b.org", "q.a.b.org", "org.", "..", "",
             "xn--p1.com", "user@example.net", "example.net:80", "a..net", "日本.org", "com", "-.net", "n" * 400 + ".net"]
    paths = ["", "/", "/en", "/en/", "/en/x?a=/de/", "/de/#f", "/fr/x", "/fr/x/longer/path/y", "/fr/", "?q", "#", "/ä/1", "/EN/", "//", "/fr/x\n/z"]
    made = [(i, f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(600)]
    made += [(i % 50, "https://hot.example.net/en/" + str(i % 7)) for i in range(600, 1500)]
    odd = [None, "", "no scheme", "mailto:a@b.net", "://", "http://", "http:///net/", "a://b://c.net/", "http://" + "a." * 3000 + "net/" + "p" * 5000]
    return made + [(None, u) for u in odd] + [(7, None), (None, None)]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "k", 5, "p") for i, u in rows], PAGES)


def test_urls_equal_plain_rules(spark):
    rows = urls()
    found = urlfilter.judge(pages(spark, rows), urlfilter.rules_frame(spark, RULES))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    wanted = Counter((i, *judged_plainly(u, RULES)) for i, u in rows)
    assert Counter(tuple(r) for r in found.collect()) == wanted
    kept = urlfilter.keep_allowed(pages(spark, rows), urlfilter.rules_frame(spark, RULES))
    assert kept.columns == PAGES.names
    allowed = Counter((i, u) for i, u in rows if judged_plainly(u, RULES)[3] == "allow")
    assert Counter((r["page_id"], r["url"]) for r in kept.collect()) == allowed


def test_urls_many_rules_and_none(spark):
    rng = random.Random(5)
    rules = [(rng.choice(["allow", "block"]), f"{rng.choice(['', 's.', 't.s.'])}h{rng.randint(0, 9)}.net/" + "a/b/c/d"[: rng.randint(0, 7)]) for _ in range(300)]
    rows = [(i, f"http://{rng.choice(['', 's.', 't.s.', 'z.'])}h{rng.randint(0, 11)}.net/" + "a/b/c/d/e"[: rng.randint(0, 9)]) for i in range(800)]
    found = urlfilter.judge(pages(spark, rows), urlfilter.rules_frame(spark, rules))
    assert Counter(tuple(r) for r in found.collect()) == Counter((i, *judged_plainly(u, rules)) for i, u in rows)
    none = urlfilter.rules_frame(spark, RULES).where("false")
    assert {r["verdict"] for r in urlfilter.judge(pages(spark, rows), none, "block").collect()} == {"block"}
    assert urlfilter.judge(pages(spark, []), urlfilter.rules_frame(spark, RULES)).count() == 0


def test_hot_host_is_cut_into_ranges(spark):
    rows = [(i, f"http://one.net/p{i}") for i in range(4000)]
    found = urlfilter.judge(pages(spark, rows), urlfilter.rules_frame(spark, RULES))
    sizes = [len(p) for p in found.rdd.glom().collect()]
    assert max(sizes) < 2.5 * 4000 / len(sizes)


VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("n", T.StringType()), T.StructField("component", T.StringType()), T.StructField("dim", T.LongType()),
])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "n", "c", 3) for i, v in rows], VECTORS)


def check_whitened(found, usable):
    x = np.floor(np.array([v for _, v in usable], np.float32).astype(float) * 64) + 1e6
    n, dims = x.shape
    centred = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(32, int((values > 1e-10 * values[0]).sum()))
    wanted = centred @ turn[:, :k] / np.sqrt(values[:k])
    whole = x.astype(np.int64)
    deviation = ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    rows = sorted(found.collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert len(rows) == n * k and {r["component"] for r in rows} == set(range(1, k + 1))
    got = np.array([r["whitened"] for r in rows]).reshape(n, k)
    order = np.argsort([i for i, _ in usable], kind="stable")
    signs = np.sign((got * wanted[order]).sum(axis=0))
    assert np.abs(got * signs - wanted[order]).max() < 1e-7
    assert [int(r["deviation"]) for r in rows[::k]] == deviation[order].tolist()
    assert np.allclose([r["explained"] for r in rows[:k]], values[:k] / values.sum(), rtol=1e-9)
    assert {r["n"] for r in rows} == {n} and rows[0]["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in rows}) == 1


def test_whitening_equals_dense(spark):
    rng = np.random.default_rng(2)
    turn = rng.standard_normal((40, 40))
    good = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((300, 40)) @ turn * 3)]
    good += [(1000 + i, good[5][1]) for i in range(100)]
    bad = [(400, None), (401, []), (402, [1.0]), (403, [None] * 40), (404, [float("nan")] * 40), (405, [float("inf")] + [0.0] * 39),
           (406, [3e38] + [0.0] * 39), (None, None)]
    check_whitened(whitening.whitened(vectors(spark, bad + good).repartition(7)), good)


def test_whitening_of_few_dimensions_and_degenerate_tables(spark):
    two = [(i, [float(i % 5), float(i % 3), 1.0]) for i in range(30)]  # the third never varies
    check_whitened(whitening.whitened(vectors(spark, two)), two)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, []), (2, [])]):
        assert whitening.whitened(vectors(spark, rows)).count() == 0


@pytest.mark.parametrize("kind", ["random", "identity", "clusters", "graded", "wilkinson", "blocks", "ones"])
def test_leading_pairs(kind):
    rng = np.random.default_rng(4)
    turn, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    matrix = {
        "random": turn @ np.diag(rng.random(30)) @ turn.T, "identity": np.eye(12), "ones": np.ones((9, 9)),
        "clusters": turn @ np.diag([4.0] * 8 + [4 - 1e-9] * 4 + [1.0] * 10 + [0.0] * 8) @ turn.T,
        "graded": turn @ np.diag(10.0 ** -np.arange(30)) @ turn.T,
        "wilkinson": np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
        "blocks": np.kron(np.eye(4), np.diag([3.0, 2.0, 2.0]) + 0.5),
    }[kind]
    values, found = whitening.leading_pairs(matrix, 32)
    assert len(values) >= 1 and np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][: len(values)], atol=1e-13)
    assert np.abs(matrix @ found.T - found.T * values).max() < 1e-13 * max(np.abs(matrix).max(), 1) * len(matrix)
    assert np.abs(found @ found.T - np.eye(len(values))).max() < 1e-13


def test_deviations_beyond_a_long():
    centre = whitening.Centre(10**9, [5 * 10**9 + 3, -(10**9)])
    found = centre.deviations(np.array([[10**9, 7], [5, -1]], np.int64))
    n = 10**9
    wanted = [(n * 10**9 - 5 * n - 3) ** 2 + (n * 7 + n) ** 2, 9]
    assert [int(x) for x in found.to_pylist()] == wanted


def collocations_plainly(rows, least, first):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        totals[lang] += 0
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i: i + k]))
                    counts[key] = counts.get(key, 0) + 1
    found = {k: f for k, f in counts.items() if f >= least}
    inner = {}
    for (lang, p), f in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                key = (lang, p[i: i + k])
                inner[key] = max(inner.get(key, 0), f)
    out = {}
    for (lang, p), a in found.items():
        if len(p) > 1 and inner.get((lang, p), 0) < a:
            n = totals[lang]
            cuts = [(1000 * a * n // (found[lang, p[:k]] * found[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), found[lang, p[:k]], found[lang, p[k:]], n))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n, -score)
        for lang, rows in out.items() for rank, (score, a, p, left, right, n) in enumerate(sorted(rows)[:first], 1)
    )


DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("phrase", T.StringType()), T.StructField("count", T.LongType()), T.StructField("n", T.StringType()),
])


def said(seed: int, words: int) -> str:
    rng = random.Random(seed)
    some = ["the", "The", "of", "a", "kind", "new", "york", "city", "é", "日本", "x\x00y", "-", "'s", "zz" * 200]
    return "".join(rng.choice(some) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " new york city ", "!"]) for _ in range(words))


@pytest.mark.parametrize("least, first", [(3, 2000), (10, 5)])
def test_phrases_equal_plain_counts(spark, monkeypatch, least, first):
    rows = [(i % 17, said(i % 23, 60), ["en", "de", None, "und", ""][i % 5]) for i in range(60)]
    rows += [(1, None, "en"), (2, "", "fr"), (3, " \t\n", None), (None, "one " * 3000, "en"), (4, "a b", "pt")]
    frame = spark.createDataFrame([(*r, "p", 1, "n") for r in rows], DOCS).repartition(5)
    found = phrases.collocations(frame, least, first)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == collocations_plainly(rows, least, first)


def test_phrases_of_nothing(spark):
    for rows in ([], [(1, None, None)], [(1, "one two three", "en")]):
        frame = spark.createDataFrame([(*r, "p", 1, "n") for r in rows], DOCS)
        assert phrases.collocations(frame).count() == 0


def test_trie_bursts_and_spills():
    rng = np.random.default_rng(6)
    trie, wanted, got = phrases.HatTrie(burst=50, limit=2000), Counter(), Counter()
    runs = 0

    def take(found):
        nonlocal runs
        for prefix, key, count in found:
            runs += 1
            assert (np.diff(prefix) >= 0).all() and all((np.diff(key[prefix == p]) > 0).all() for p in np.unique(prefix))
            got.update(dict(zip(key.tolist(), (count + [got[k] * 0 for k in key.tolist()]).tolist(), strict=True)))

    for _ in range(40):
        keys = np.unique(rng.integers(0, 9000, 500)).astype(np.uint64)
        counts = rng.integers(1, 9, len(keys))
        path = np.column_stack(((keys % np.uint64(64)).astype(np.int64), (keys % np.uint64(7)).astype(np.int64)))
        trie.add(path, keys, counts)
        wanted.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        take(trie.spill())
        assert trie.size <= 2000
    assert isinstance(trie.root, list) and runs > 5
    take(trie.rest())
    assert got == wanted and trie.size == 0


def test_filter_is_bounded_and_lets_members_through(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 15)
    ids = [(i * 0x9E3779B97F4A7C15) % (1 << 64) - (1 << 63) for i in range(3000)]
    bits = phrases._bits(spark, spark.createDataFrame([(i,) for i in ids], "id long"))
    assert len(bits) == 1 << 12
    assert phrases.Filter(bits)(np.array(ids, np.int64).astype(np.uint64)).all()
