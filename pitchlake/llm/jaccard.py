"""Near duplicates by n-gram Jaccard similarity: a MinHash LSH forest, then exact verification.

Every text becomes the set of its 5-word shingles and a signature of ``TREES * DEPTH`` minima, of which
each tree takes ``DEPTH`` as a path. Paths are sorted tree by tree over all tasks, which is the tree's prefix trie in
sorted order: texts below one node stand next to each other. Matched prefixes are shortened step by step. Each
text has a depth at which its own trees reach the target recall; fewer trees are worth counting where bins
without shingles borrow from the same ones. The first step links what shares the longest of these depths,
and each further step goes one value up for the texts that still need it, until none does.

A text of fewer than ``SHORT`` shingles cannot fill its bins, so pairs with one are found exactly, by a prefix filter:
of two sets as similar as the threshold, the rarest few shingles of each hold one in common.

Texts with equal shingle sets are one class and enter once. Candidates are gathered to groups by stars, never by
pairs; within a group, blocks of a bounded number of texts are verified against each other exactly, each
pair of blocks in one task, and only counts and a spanning forest of the links leave it. A group of N texts takes
N / ``BLOCK_TEXTS`` copies of each text's shingles, the price of an exact number of links.

Defined results
    Words are runs of anything but white space, A-Z lowered. A text of fewer than five words has one
    shingle, all its words. Null, empty or blank texts have no shingles and no links; each is its own
    class. Repeated rows are copies of each other. Links count every other document, copies included.
    Null doc_id: takes part; the class is named by the smallest id of its documents, null if none has one.
    No rows: no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.graph import components
from pitchlake.llm.store import written
from pitchlake.llm.text import SPACED, blocks, mix, texts, token_bounds, tokens, windows

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
TREES = 32
DEPTH = 8
SHORT = 64
STEP_BITS = 16  # of a value that a path keeps; equal bits of different values only add candidates
BLOCK_TEXTS = 512
BLOCK_SHINGLES = 1 << 19
BINS = TREES * DEPTH


def depth_for(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which pairs of the threshold's similarity meet with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    rows = len(offsets) - 1
    found = tokens(data, offsets, SPACED)
    value, at = windows(found.hash, found.text, SHINGLE)
    cut = np.searchsorted(found.text[at], np.arange(rows + 1))
    words = token_bounds(found, rows)
    sets = []
    for i in range(rows):
        if cut[i] < cut[i + 1]:
            sets.append(np.unique(value[cut[i]: cut[i + 1]]))
        elif words[i] < words[i + 1]:
            short = found.hash[words[i]: words[i + 1]]
            sets.append(windows(short, np.zeros(len(short), int), len(short))[0])
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


_EDGES = np.array([(i << 64) // BINS for i in range(BINS)], np.uint64)
# Where an empty bin looks next, the same for every text.
_PROBES = (mix(np.arange(BINS * 64, dtype=np.uint64) + np.uint64(77)) % np.uint64(BINS)).astype(np.int64).reshape(64, BINS)


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least shingle of each of the ``BINS`` ranges, and the range it is from: an empty one borrows from others."""
    at = np.searchsorted(shingles, _EDGES)
    last = np.append(at[1:], len(shingles))
    full = at < last
    source = np.arange(BINS)
    if not full.all():
        open_ = ~full
        for probe in _PROBES:
            source[open_] = probe[open_]
            open_ = ~full[source]
            if not open_.any():
                break
        source[open_] = np.flatnonzero(full)[0]
    return shingles[at[source]], source


def _path(minima: np.ndarray) -> np.ndarray:
    """Each tree's path as two words, its first value in the highest bits."""
    steps = mix(minima.reshape(TREES, DEPTH)) >> np.uint64(64 - STEP_BITS)
    shifts = np.arange(DEPTH // 2, dtype=np.uint64)[::-1] * np.uint64(STEP_BITS)
    return np.bitwise_or.reduce(steps.reshape(TREES, 2, DEPTH // 2) << shifts, axis=2)


def stop_depth(source: np.ndarray, threshold: float, recall: float) -> int:
    """The longest prefix at which this text's trees, those from the same ranges counted once, reach the recall."""
    trees = source.reshape(TREES, DEPTH)
    for depth in range(depth_for(threshold, recall), 1, -1):
        different = len(np.unique(np.sort(trees[:, :depth], axis=1), axis=0))
        if 1 - (1 - threshold**depth) ** different >= recall:
            return depth
    return 1


def fingerprint(shingles: np.ndarray) -> int:
    """One number for a whole shingle set, as a signed long."""
    if not len(shingles):
        return 0
    both = np.array([np.add.reduce(mix(shingles)), np.bitwise_xor.reduce(shingles), len(shingles)], np.uint64)
    return int(windows(both, np.zeros(3, int), 3)[0].astype(np.int64)[0])


def _sign(batches: Iterator[pa.RecordBatch], threshold: float, recall: float) -> Iterator[pa.RecordBatch]:
    deepest = depth_for(threshold, recall)
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        prints, sizes, paths, stops, few = [], [], [], [], []
        for first, last in blocks(offsets):
            for s in shingle_sets(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first]):
                prints.append(fingerprint(s))
                sizes.append(len(s))
                path = stop = None
                if len(s) >= SHORT:
                    minima, source = signature(s)
                    path = _path(minima).tobytes()
                    own = (source == np.arange(BINS)).all()
                    stop = deepest if own else stop_depth(source, threshold, recall)
                paths.append(path)
                stops.append(stop)
                few.append(s.astype(np.int64) if 0 < len(s) * threshold < SHORT else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(prints, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(paths, pa.binary()), pa.array(stops, pa.int32()), pa.array(few, pa.list_(pa.int64())),
            ],
            ["doc_id", "print", "size", "paths", "stop", "few"],
        )


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each tree of each class."""
    for batch in batches:
        rows = batch.num_rows
        words = np.frombuffer(b"".join(batch.column("paths").to_pylist()), np.int64).reshape(rows * TREES, 2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.tile(np.arange(TREES, dtype=np.int32), rows)), pa.array(words[:, 0].copy()),
                pa.array(words[:, 1].copy()), pa.array(np.repeat(batch.column("print").to_numpy(), TREES)),
                pa.array(np.repeat(batch.column("stop").to_numpy(), TREES)),
            ],
            ["tree", "high", "low", "print", "stop"],
        )


def _masks(depth: int) -> tuple[int, int]:
    """What the first ``depth`` values of a path take up of its two words, as signed longs."""
    every = (1 << 64) - 1
    half = DEPTH // 2
    signed = [
        (every << (64 - STEP_BITS * n)) & every if n else 0 for n in (min(depth, half), max(depth - half, 0))
    ]
    return tuple(m - (1 << 64) if m >> 63 else m for m in signed)


def _runs(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Of sorted paths, an edge (u, v) from each to the first of its run with equal prefix.

    The first and the last row come with their prefixes and no v, since their runs may go on in another task.
    """
    high_mask, low_mask = _masks(depth)
    before = None  # prefix and first print of the open run
    final = None

    def rows(u, v, key):
        n = len(u)
        given = np.full(n, key is not None)
        tree, high, low = key or (0, 0, 0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(u, pa.int64()), pa.array(v, pa.int64(), mask=given),
                *(pa.array(np.full(n, x), t, mask=~given) for x, t in ((tree, pa.int32()), (high, pa.int64()), (low, pa.int64()))),
            ],
            ["u", "v", "tree", "high", "low"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        tree = batch.column("tree").to_numpy()
        high = batch.column("high").to_numpy() & np.int64(high_mask)
        low = batch.column("low").to_numpy() & np.int64(low_mask)
        prints = batch.column("print").to_numpy()
        new = np.append(True, (tree[1:] != tree[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        first = prints[start]
        key = (int(tree[0]), int(high[0]), int(low[0]))
        if before is None:
            yield rows(prints[:1], prints[:1], key)
        elif before[0] == key:
            first = np.where(start == 0, before[1], first)
        linked = first != prints
        yield rows(prints[linked], first[linked], None)
        before = ((int(tree[-1]), int(high[-1]), int(low[-1])), first[-1])
        final = prints[-1:]
    if before is not None:
        yield rows(final, final, before[0])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        for first, last in blocks(offsets):
            sets = shingle_sets(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["print", "shingles"],
            )


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether the Jaccard similarity of each two sets is at least the threshold, exactly."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.append(True, every[1:] != every[:-1])
    place = np.cumsum(new) - 1
    shared = np.bincount(place) > 1  # only these can be in an intersection
    kept = shared[place]
    column = (np.cumsum(shared) - 1)[place[kept]]
    owner = owner[kept]
    both = np.zeros((n, n), np.float32)
    width = 4096
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        both += part @ part.T
    union = size[:, None] + size[None, :] - both
    # |A and B| / |A or B| >= t, in whole numbers: compared as doubles with room for their last bit.
    linked = both.astype(np.float64) >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def _verify(table: pa.Table, threshold: float) -> pa.Table:
    """Links within one block (i = j), or between two blocks: counts, and a spanning forest."""
    prints = table.column("print").to_numpy()
    copies = table.column("copies").to_numpy()
    side = table.column("side").to_numpy()
    order = np.argsort(prints, kind="stable")
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    linked = similar([sets[i] for i in order], threshold)
    prints, copies, side = prints[order], copies[order], side[order]
    if table.column("i")[0].as_py() != table.column("j")[0].as_py():
        linked &= side[:, None] != side[None, :]
    count = linked @ copies
    root = _forest(linked)
    used = np.flatnonzero(linked.any(axis=1))
    return pa.table({
        "print": pa.array(prints[used], pa.int64()), "root": pa.array(prints[root[used]], pa.int64()),
        "links": pa.array(count[used], pa.int64()),
    })


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component."""
    root = np.arange(len(linked))
    while True:
        near = np.where(linked, root[None, :], len(linked)).min(axis=1)
        least = np.minimum(root, near)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def near_duplicates(
    documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, class_id, copy_id, n_links) of every document.

    class_id is the smallest doc_id that links lead to, copy_id that of the documents with the same shingles, and
    n_links the number of other documents whose similarity is at least the threshold.
    """
    signed, told = _told(documents, threshold, recall, doc_id, text)
    with_words = signed.where("size > 0").select("doc_id", "print").join(told, "print")
    without = signed.where("size = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links")
    )
    return with_words.select(*without.columns).unionByName(without)


def _told(documents: DataFrame, threshold: float, recall: float, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print, size) of each row, and (print, root, class_id, copy_id, n_links) of each shingle set."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = written(
        rows.mapInArrow(
            lambda b: _sign(b, threshold, recall),
            f"doc_id {kind}, print long, size long, paths binary, stop int, few array<long>",
        ), "jaccard-signed"
    )
    classes = written(
        signed.where("size > 0").groupBy("print").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("copy_id"), F.max("size").alias("size"),
            F.first("paths").alias("paths"), F.first("stop").alias("stop"), F.first("few").alias("few"),
        ), "jaccard-classes",
    )
    edges = _forest_edges(classes, depth_for(threshold, recall)).unionByName(_short_edges(classes, threshold))
    groups = written(components(edges.distinct()), "jaccard-groups")
    found = written(_links(rows, classes, groups, threshold, kind), "jaccard-links")
    counts = written(found.groupBy("print").agg(F.sum("links").alias("links")), "jaccard-counts")
    roots = components(found.select(F.col("print").alias("u"), F.col("root").alias("v")))
    named = classes.select("print", "copies", "copy_id").join(counts, "print", "left").join(
        roots.withColumnRenamed("id", "print"), "print", "left"
    ).withColumn("root", F.coalesce("root", "print"))
    named = written(named, "jaccard-named")
    least = written(named.groupBy("root").agg(F.min("copy_id").alias("class_id")), "jaccard-least")
    told = written(named.join(least, "root").select(
        "print", "root", "class_id", "copy_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    ), "jaccard-told")
    return signed, told


def _stars(placed: DataFrame, *key: str) -> DataFrame:
    """Edges (u, v) from each print to the least with its key, for keys of two or more."""
    shared = placed.groupBy(*key).agg(F.min("print").alias("v"), F.max("print").alias("w")).where("v <> w")
    shared = written(shared.drop("w"), "jaccard-buckets")
    return placed.join(shared, list(key)).select(F.col("print").alias("u"), "v").where("u <> v")


def _forest_edges(classes: DataFrame, depth: int) -> DataFrame:
    """Edges between classes that share a prefix as long as the shorter of their stops, over all trees."""
    branches = classes.where("paths IS NOT NULL").select("print", "stop", "paths").mapInArrow(
        _branches, "tree int, high long, low long, print long, stop int"
    )
    branches = written(branches, "jaccard-branches")
    # Ranges end anywhere, also within a run of equal paths, so that none is hot.
    order = ["tree", "high", "low", "print"]
    runs = branches.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda b: _runs(b, depth), "u long, v long, tree int, high long, low long"
    )
    runs = written(runs, "jaccard-runs")
    ends = runs.where("v IS NULL").select(F.col("u").alias("print"), "tree", "high", "low")
    edges = runs.where("v IS NOT NULL").select("u", "v").unionByName(_stars(ends, "tree", "high", "low"))
    for shorter in range(depth - 1, 0, -1):
        high_mask, low_mask = _masks(shorter)
        placed = branches.select(
            "print", "stop", "tree", F.col("high").bitwiseAND(F.lit(high_mask)).alias("high"),
            F.col("low").bitwiseAND(F.lit(low_mask)).alias("low"),
        )
        nodes = placed.where(F.col("stop") <= shorter).select("tree", "high", "low").distinct()
        nodes = written(nodes, "jaccard-nodes")
        if nodes.isEmpty():
            break
        edges = edges.unionByName(_stars(placed.join(nodes, ["tree", "high", "low"]), "tree", "high", "low"))
    return edges


def _short_edges(classes: DataFrame, threshold: float) -> DataFrame:
    """Edges that lead together all similar pairs of which one has fewer than ``SHORT`` shingles.

    Shingles are ordered by the number of sets that hold them. Those of one set only fill the front of
    the order, so texts around a common passage do not meet by it.
    """
    each = classes.where("few IS NOT NULL").select("print", "size", F.explode("few").alias("shingle"))
    common = written(each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "jaccard-common")
    held = each.join(common, "shingle").groupBy("print", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("held")
    )
    length = F.col("size") - F.ceil(F.col("size") * F.lit(threshold) - 1e-9) + 1
    front = F.greatest(length - (F.col("size") - F.size("held")), F.lit(0)).cast("int")
    placed = written(
        held.select("print", F.explode(F.slice("held", F.lit(1), front)).alias("x")).select("print", "x.shingle"), "jaccard-fronts"
    )
    return _stars(placed, "shingle")


def _links(rows: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, kind: str) -> DataFrame:
    members = groups.withColumnRenamed("id", "print").join(classes.drop("paths", "stop", "few"), "print")
    members = written(members, "jaccard-members")
    # A group is dealt to so many blocks that each holds a bounded number of texts and shingles.
    parts = written(members.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("parts")
    ), "jaccard-parts")
    members = members.join(parts, "root").withColumn("part", F.pmod(F.xxhash64("print"), F.col("parts")).cast("int"))
    members = written(members, "jaccard-parted")
    # One document of each class brings its text; another of the same id is told apart by its print.
    wanted = members.select(F.col("copy_id").alias("wanted_id")).distinct()
    chosen = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["wanted_id"]), "left_semi").select("text")
    sets = chosen.mapInArrow(_sets, "print long, shingles binary").dropDuplicates(["print"])
    sets = written(sets, "jaccard-sets")
    dealt = members.select("root", "print", "copies", "part", "parts").join(sets, "print").select(
        "root", "print", "copies", F.col("part").alias("side"), "shingles",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"),
    ).select(
        "root", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "print", "copies", "side", "shingles"
    )
    return dealt.groupBy("root", "i", "j").applyInArrow(
        lambda t: _verify(t, threshold), "print long, root long, links long"
    )


def keep_one(
    documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``documents``, all their columns, less all but one row of each class.

    A row with the smallest id of its class stays; of a class without ids, any one row.
    """
    signed, told = _told(documents, threshold, recall, doc_id, text)
    told = told.where("n_links > 0").select("print", "root", "class_id")
    # Decisions are made on ids and fingerprints; texts are not sent through the joins that lead to them.
    placed = signed.select("doc_id", "print").join(told, "print", "left")
    first = F.col("doc_id").eqNullSafe(F.col("class_id"))
    ids = placed.groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.bool_or(F.col("root").isNull() | first).alias("stays")
    ).where("rows > 1 OR NOT stays")
    ids = written(ids.select(F.col("doc_id").alias("_id"), "rows"), "jaccard-ids")
    # The small side is hashed, so that texts of the other are dealt but not sorted.
    rest = documents.join(ids.hint("shuffle_hash"), documents[doc_id].eqNullSafe(ids["_id"]), "left_anti")
    return rest.unionByName(_one_of_repeated(documents, ids.where("rows > 1").select("_id"), told, doc_id, text))


def _one_of_repeated(documents: DataFrame, ids: DataFrame, told: DataFrame, doc_id: str, text: str) -> DataFrame:
    """What stays of the rows whose id occurs on several: these are told apart by their fingerprints."""
    names = documents.columns
    mark = "print"
    while any(n.lower().startswith(mark) for n in names):
        mark += "_"
    schema = T.StructType([*documents.schema.fields, T.StructField(mark, T.LongType())])
    rows = documents.join(ids.hint("shuffle_hash"), documents[doc_id].eqNullSafe(ids["_id"]), "left_semi")
    rows = rows.mapInArrow(lambda b: _prints(b, text, mark), schema)
    told = told.select(
        F.col("print").alias(mark), F.col("root").alias(f"{mark}_root"), F.col("class_id").alias(f"{mark}_class")
    )
    rows = rows.join(told, mark, "left")
    alone = rows.where(F.col(f"{mark}_root").isNull())
    firsts = rows.where(F.col(f"{mark}_root").isNotNull() & F.col(doc_id).eqNullSafe(F.col(f"{mark}_class")))
    return alone.unionByName(firsts.dropDuplicates([f"{mark}_root"])).select(*names)


def _prints(batches: Iterator[pa.RecordBatch], text: str, mark: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts(batch.column(text))
        found = [
            fingerprint(s) for first, last in blocks(offsets)
            for s in shingle_sets(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, mark])
