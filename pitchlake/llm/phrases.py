"""Phrase collocation mining with HAT-trie counts.

Three passes over whole texts count words, pairs of neighbours, then phrases of two to ``LONGEST`` words. A
phrase cannot be frequent unless every part of it is, so a pass leaves out what a shorter part already
rules out; the filter between passes is a table of bits over hashes, of bounded size, which only ever lets
too much through. All that remains is counted in full and compared as text.

In a task the counts are in a HAT-trie: nodes branch by word id over hash containers; a container that
holds more than ``BURST`` phrases bursts into children by its next word, down to two words. When a trie
holds more than ``LIMIT`` phrases (``NAMED_LIMIT`` with their texts), its largest subtrees leave whole as
sorted runs, and the rest at the end. Spark deals the runs by the phrase's prefix and merges them; a prefix is spread over ``SALTS`` places, so
that a very common word or pair is not one task's work.

A cut of a candidate, its score and the longer candidates that absorb it come from joins of the frequent
phrases with themselves, at most four cuts and nine inner phrases for each.

Defined results
    Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and line breaks (\\x0A-\\x0D) into pieces, these at
    spaces and tabs into words. Counts are per language, null: ``und``. A null or empty text has no words.
    Repeated rows and rows of one id count each. A language without candidates gives no rows; no rows: no
    rows. Scores are whole numbers, exact up to 38 digits, beyond which the query stops with an error.
    Equal scores: the more frequent phrase, then the smaller in bytes. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.llm.store import written
from pitchlake.llm.text import Classes, Tokens, blocks, mix, texts, tokens

LONGEST = 5
LEAST = 100
FIRST = 2000
BURST = 1 << 14
LIMIT = 1 << 20
NAMED_LIMIT = 1 << 18  # where each phrase's text is held beside its count
FAN = 64  # children of a node: words share one by hash
DEEPEST = 2
SALTS = 64
BLOCK = 2 << 20
UNKNOWN = "und"
BUCKET = 1 << 15  # bits in a row of Spark's bitmaps
MOST_BITS = 1 << 29  # 64 MB, the most that a filter may have
BITS_EACH = 64

_MARKS = [*b".,;:!?", *range(10, 14)]
_KIND = np.ones(256, np.uint8)
_KIND[[32, 9, *_MARKS]] = 0
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
WORDS = Classes(_KIND, _FOLD)
_IS_MARK = np.zeros(256, np.int64)
_IS_MARK[_MARKS] = 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


class HatTrie:
    """Counts of keys below a path of word ids."""

    def __init__(self, burst: int = BURST, limit: int = LIMIT):
        self.burst, self.limit = burst, limit
        self.size = 0
        # A subtree is a container (key -> count), or a node: a list of subtrees by the word's digit.
        self.root: dict | list = {}

    def add(self, path: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        """Counts of distinct keys; ``path`` has the digits of each key's first words, a row per key."""
        order = np.lexsort((path[:, 1], path[:, 0]))
        self.root = self._add(self.root, 0, path[order], keys[order], counts[order])

    def _add(self, tree: dict | list, depth: int, path: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        if isinstance(tree, list):
            digits = path[:, depth]
            cut = np.searchsorted(digits, np.arange(FAN + 1))
            for d in np.unique(digits):
                a, b = cut[d], cut[d + 1]
                tree[d] = self._add(tree[d], depth + 1, path[a:b], keys[a:b], counts[a:b])
            return tree
        before = len(tree)
        digits = path[:, 1] + path[:, 0] * FAN
        for key, count, digit in zip(keys.tolist(), counts.tolist(), digits.tolist(), strict=True):
            found = tree.get(key)
            tree[key] = (count, digit) if found is None else (found[0] + count, digit)
        self.size += len(tree) - before
        if len(tree) > self.burst and depth < DEEPEST:
            node: list = [{} for _ in range(FAN)]
            for key, entry in tree.items():
                digit = entry[1] // FAN if depth == 0 else entry[1] % FAN
                node[digit][key] = entry
            return node
        return tree

    def spill(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """While the trie is too large: its largest subtrees, each as a sorted run."""
        if self.size <= self.limit:
            return
        if isinstance(self.root, dict):
            yield from self.rest()
            return
        sizes = [_size(t) for t in self.root]
        for d in sorted(range(FAN), key=lambda d: -sizes[d]):
            if self.size <= self.limit // 2:
                break
            yield _run(self.root[d])
            self.root[d] = {}
            self.size -= sizes[d]

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Everything that is left, subtree by subtree."""
        for tree in self.root if isinstance(self.root, list) else [self.root]:
            if _size(tree):
                yield _run(tree)
        self.root, self.size = {}, 0


def _size(tree: dict | list) -> int:
    return len(tree) if isinstance(tree, dict) else sum(_size(t) for t in tree)


def _entries(tree: dict | list) -> Iterator[dict]:
    if isinstance(tree, dict):
        yield tree
    else:
        for t in tree:
            yield from _entries(t)


def _run(tree: dict | list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix, key, count) of a subtree in order."""
    found = list(_entries(tree))
    n = sum(len(c) for c in found)
    key = np.fromiter((k for c in found for k in c), np.uint64, n)
    flat = np.fromiter((x for c in found for e in c.values() for x in e), np.int64, 2 * n).reshape(n, 2)
    order = np.lexsort((key, flat[:, 1]))
    return flat[order, 1], key[order], flat[order, 0]


class Filter:
    """Whether a key may be frequent; ``bits`` of None lets all through."""

    def __init__(self, bits: bytes | None):
        self.bits = None if bits is None else np.frombuffer(bits, np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(keys), bool)
        at = keys & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Block:
    """The words of some texts: ids that differ by language, and the piece each is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self.data = _FOLD[data]
        self.found: Tokens = tokens(data, offsets, WORDS)
        self.word = mix(self.found.hash + langs[self.found.text])
        # Marks before a word, and its text: together they grow where a piece ends, and nowhere else.
        marks = np.cumsum(_IS_MARK[data])
        self.piece = (marks[self.found.start] if len(self.found.start) else np.zeros(0, np.int64)) + self.found.text

    def phrases(self, size: int, may: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(key, index of the first word) of the phrases within pieces; ``may``: whether the pair at a word counts."""
        n = len(self.word) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        inside = self.piece[:n] == self.piece[size - 1:]
        if may is not None:
            for i in range(size - 1):
                inside &= may[i: i + n]
        at = np.flatnonzero(inside)
        key = np.full(len(at), size, np.uint64)
        for i in range(size):
            key = (key + self.word[at + i]) * _STEP
            key ^= key >> np.uint64(29)
        return mix(key), at

    def text(self, at: int, size: int) -> str:
        start, length = self.found.start[at: at + size].tolist(), self.found.length[at: at + size].tolist()
        return " ".join(bytes(self.data[a: a + n]).decode() for a, n in zip(start, length, strict=True))

    def path(self, at: np.ndarray, words: np.ndarray | int) -> np.ndarray:
        """Digits of the first two words; a phrase of one word has 0 for the second."""
        digit = (self.word % np.uint64(FAN)).astype(np.int64)
        second = np.where(np.asarray(words) > 1, digit[np.minimum(at + 1, len(digit) - 1)], 0)
        return np.column_stack((digit[at], second))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray, list[str]]]:
    """Blocks of texts with the index of each text's language, and the languages."""
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        known = batch.column("lang").fill_null(UNKNOWN).dictionary_encode()
        names, index = known.dictionary.to_pylist(), known.indices.to_numpy()
        hashes = np.array([lang_hash(x) for x in names], np.uint64)
        for first, last in blocks(offsets, BLOCK):
            inner = offsets[first: last + 1] - offsets[first]
            yield Block(data[offsets[first]: offsets[last]], inner, hashes[index[first:last]]), index[first:last], names


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of one occurrence of each, and how many there are."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(key) else np.zeros(0, np.int64)
    return ordered[new], order[new], np.diff(np.append(new, len(key)))


NAMED = "lang string, phrase string, size int, id long, count long"


def _named(batches: Iterator[pa.RecordBatch], filters) -> Iterator[pa.RecordBatch]:
    """Runs of phrases with their text: words if there is no filter, else longer ones of frequent pairs.

    Words come with a row per language, of size 0, that counts all of them.
    """
    trie, said, total = HatTrie(limit=NAMED_LIMIT), {}, {}
    may_word, may_pair = (Filter(x) for x in filters.value) if filters else (None, None)

    def rows(runs) -> Iterator[pa.RecordBatch]:
        for _, key, count in runs:
            names = [said.pop(k) for k in key.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.string()),
                pa.array([n[2] for n in names], pa.int32()), pa.array(key.astype(np.int64), pa.int64()), pa.array(count, pa.int64()),
            ], ["lang", "phrase", "size", "id", "count"])

    for block, langs, names in _blocks(batches):
        found = block.found
        if filters is None:
            for i, n in zip(*np.unique(langs[found.text], return_counts=True), strict=True):
                total[names[i]] = total.get(names[i], 0) + int(n)
            made = [(1, block.word, np.arange(len(block.word)))]
        else:
            good = may_word(block.word)
            key, at = block.phrases(2)
            pair = np.zeros(len(block.word), bool)
            pair[at] = good[at] & good[at + 1] & may_pair(key)
            made = [(size, *block.phrases(size, pair)) for size in range(2, LONGEST + 1)]
        for size, key, at in made:
            key, one, count = _counted(key)
            at = at[one]
            for k, place in zip(key.tolist(), at.tolist(), strict=True):
                if k not in said:
                    said[k] = (names[langs[found.text[place]]], block.text(place, size), size)
            trie.add(block.path(at, size), key, count)
        yield from rows(trie.spill())
    yield from rows(trie.rest())
    if total:
        yield pa.RecordBatch.from_arrays([
            pa.array(list(total), pa.string()), pa.array([""] * len(total), pa.string()), pa.array([0] * len(total), pa.int32()),
            pa.array([0] * len(total), pa.int64()), pa.array(list(total.values()), pa.int64()),
        ], ["lang", "phrase", "size", "id", "count"])


def _pairs(batches: Iterator[pa.RecordBatch], words) -> Iterator[pa.RecordBatch]:
    """Runs of pairs of frequent words, by hash: they only serve to rule longer phrases out."""
    trie, may = HatTrie(), Filter(words.value)

    def rows(runs) -> Iterator[pa.RecordBatch]:
        for prefix, key, count in runs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix, pa.int32()), pa.array(key.astype(np.int64), pa.int64()), pa.array(count, pa.int64())],
                ["prefix", "id", "count"],
            )

    for block, _, _ in _blocks(batches):
        good = may(block.word)
        key, at = block.phrases(2, good[:-1] & good[1:] if len(good) else good)
        key, one, count = _counted(key)
        trie.add(block.path(at[one], 2), key, count)
        yield from rows(trie.spill())
    yield from rows(trie.rest())


def _bits(spark: SparkSession, frequent: DataFrame) -> bytes:
    """A table of bits with the hashes of the frequent phrases set; at most ``MOST_BITS``, however many there are."""
    count = frequent.count()
    size = BUCKET
    while size < min(MOST_BITS, count * BITS_EACH):
        size *= 2
    at = F.col("id").bitwiseAND(F.lit(size - 1).cast("long")) + 1
    rows = (
        frequent.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    made = bytearray(size // 8)
    for r in rows.collect():  # a row per 32 768 bits
        first = (r["bucket"] - 1) * (BUCKET // 8)
        made[first: first + BUCKET // 8] = r["bits"]
    return bytes(made)


def _merged(runs: DataFrame, prefix: Column, keys: list[str], least: int) -> DataFrame:
    """Counts of at least ``least``, from runs dealt by prefix; what the salt splits stays apart by key."""
    dealt = runs.withColumn("prefix", prefix).withColumn("salt", F.pmod(F.xxhash64(*keys), F.lit(SALTS)).cast("int"))
    dealt = dealt.repartition("prefix", "salt").groupBy("prefix", "salt", *keys)
    return dealt.agg(F.sum("count").alias("count")).where(F.col("count") >= least).drop("prefix", "salt")


def frequent_phrases(
    documents: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, count) of all phrases of 1 to ``LONGEST`` words that occur ``least`` times, and (lang, n)."""
    spark = documents.sparkSession
    rows = documents.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    first = F.xxhash64("lang", F.substring_index("phrase", " ", 2))
    words = written(_merged(
        rows.mapInArrow(lambda b: _named(b, None), NAMED), first, ["lang", "phrase", "size", "id"], min(least, 1)
    ).where(f"size = 0 OR count >= {int(least)}"), "phrases-words")
    held = spark.sparkContext.broadcast(_bits(spark, words.where("size = 1")))
    pairs = written(_merged(
        rows.mapInArrow(lambda b: _pairs(b, held), "prefix int, id long, count long"), F.col("prefix"), ["id"], least
    ), "phrases-pairs")
    both = spark.sparkContext.broadcast((held.value, _bits(spark, pairs)))
    longer = _merged(
        rows.mapInArrow(lambda b: _named(b, both), NAMED).drop("id"), first, ["lang", "phrase", "size"], least
    )
    longer = written(longer, "phrases-longer")
    every = words.where("size = 1").drop("id").unionByName(longer)
    return every.select("lang", "phrase", "size", "count"), words.where("size = 0").select("lang", F.col("count").alias("n"))


def _part(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def scored(every: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one absorbs."""
    found = every.where("size > 1").select("lang", "phrase", "size", F.col("count").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = found.select(
        "lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", _part(1, F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size")).alias("right")
    )
    for side, name in (("left", "l"), ("right", "r")):
        part = every.select("lang", F.col("phrase").alias(side), F.col("count").alias(name))
        cuts = cuts.join(part, ["lang", side])
    exact = [F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")]
    score = F.call_function("div", exact[0] * exact[1] * F.lit(1000).cast("decimal(38,0)"), exact[2] * exact[3])
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = cuts.join(totals, "lang").withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(least)
    # Phrases inside a longer one, and how often the longer one occurs.
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("size") - size + 1), lambda at: F.struct(at.alias("at"), size.alias("n"))),
    ))
    inner = found.where("size > 2").select("lang", "a", "words", F.explode(spans).alias("span")).select(
        "lang", _part(F.col("span.at"), F.col("span.n")).alias("phrase"), "a"
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    documents: DataFrame, least: int = LEAST, first: int = FIRST, text: str = "text", lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score, count and text."""
    rows = scored(*frequent_phrases(documents, least, text, lang))
    # In two steps, so that no task holds all phrases of a language.
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    for keys in (("lang", "part"), ("lang",)):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= first)
    return rows.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
