"""Exact removal of passages that a document with a smaller id holds too: a sparse suffix array.

Of all suffixes only anchors are kept: in each window of ``LENGTH`` bytes the ``GRAM`` bytes of least hash. Two
equal windows have the same anchor at the same place, so suffixes need sorting only within groups of
equal anchors. The windows that share an anchor form a span; equal spans are found by their hashes,
and the smallest id that holds a span decides for all its windows at once. Only spans that differ from
others of their anchor go on: their windows are suffixes sorted deep-shallow: multikey sorting by their
first ``SHALLOW`` bytes, and where more is shared blind tries, which look only at the bytes where a group
branches, built level by level for all groups together. Neighbours that are equal over the whole length are repeats.

Documents are dealt once into blocks of about ``BLOCK`` bytes. A block sends each of its spans once, with its
smallest id, however many of its documents hold it, and gets back ordinals; texts travel only
within their block. So a passage held by every document costs a row per block, not per document.

Defined results
    Ids are whole numbers. A null id takes no part: its text is kept whole and removes nothing.
    Null or empty text: no bytes. Rows of one id never remove each other's bytes. Texts shorter than
    ``LENGTH`` are kept whole. Spans are told apart by 88 bits of hash within a group of equal anchors.
    No rows: no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.store import written
from pitchlake.llm.text import _powers, _room, lean, mix, texts

LENGTH = 50
GRAM = 24
SHALLOW = 16
BLOCK = 8 << 20
SEGMENT = 1 << 20
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 128
NEAR = LENGTH - GRAM + 1  # anchors to choose from in a window
NOBODY = np.iinfo(np.int64).max
_POSITION = np.uint64((1 << 24) - 1)


@dataclass
class Spans:
    """Runs of windows with one anchor: document (index), first and last window, hashes of anchor and span."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    span: np.ndarray


def _segment(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of the windows of ``data``; ``ends`` is where the document of each byte ends."""
    n = len(data)
    power, inverse = _powers(_room(n))
    running = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=running[1:])
    grams = n - GRAM + 1
    value = mix((running[GRAM:] - running[:grams]) * inverse[:grams])
    least = (value & ~_POSITION) | np.arange(grams, dtype=np.uint64)
    width = 1
    while 2 * width <= NEAR:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    starts = n - LENGTH + 1
    least = np.minimum(least[:starts], least[NEAR - width: NEAR - width + starts])
    at = (least & _POSITION).astype(np.int64)
    valid = np.flatnonzero(np.arange(starts) + LENGTH <= ends[:starts])
    if not len(valid):
        return (valid,) * 4
    at = at[valid]
    new = np.append(True, (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1))
    first = valid[new]
    last = valid[np.append(np.flatnonzero(new)[1:] - 1, len(valid) - 1)]
    anchor = at[new]
    body = (running[last + LENGTH] - running[first]) * inverse[first]
    shape = (anchor - first) * 64 + (last - first)
    return first, last, value[anchor], mix(body * np.uint64(0x9E3779B97F4A7C15) + shape.astype(np.uint64))


def spans(data: np.ndarray, offsets: np.ndarray, takes_part: np.ndarray) -> Spans:
    ends_of = np.where(takes_part, offsets[1:], -1)
    size = np.diff(offsets)
    parts, n = [], len(data)
    for a in range(0, n, SEGMENT):
        b = min(a + SEGMENT + LENGTH - 1, n)
        if b - a < LENGTH:
            break
        rows = slice(*np.searchsorted(offsets, [a, b], "right") - np.array([1, 0]))
        low = np.maximum(offsets[:-1][rows], a)
        ends = np.repeat(ends_of[rows], np.maximum(np.minimum(offsets[1:][rows], b) - low, 0) * (size[rows] > 0))
        first, last, anchor, span = _segment(data[a:b], ends - a)
        parts.append((first + a, last + a, anchor, span))
    if not parts:
        none = np.zeros(0, np.int64)
        return Spans(none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    first, last, anchor, span = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Spans(np.searchsorted(offsets, first, "right") - 1, first, last, anchor, span)


def shallow_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings by their first bytes, and for each place whether it starts a new group."""
    words = [rows[:, i: i + 8].copy().view(">u8")[:, 0] for i in range(0, SHALLOW, 8)]
    order = np.lexsort(words[::-1])
    new = np.ones(len(rows), bool)
    new[1:] = np.logical_or.reduce([w[order][1:] != w[order][:-1] for w in words])
    return order, new


def blind_tries(rows: np.ndarray, order: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Refine groups of equal beginnings until each holds equal strings.

    A level looks, in each group, only at the first byte where some member departs from the first one:
    the branching node of that group's trie.
    """
    group = np.cumsum(new) - 1
    open_ = np.flatnonzero(np.bincount(group)[group] > 1)
    while len(open_):
        of = group[open_]
        at = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        part = rows[order[open_]]
        leader = np.repeat(part[at], np.diff(np.append(at, len(of))), axis=0)
        differs = np.logical_or.reduceat(part != leader, at, axis=0)
        branches = differs.any(axis=1)
        branch = np.repeat(differs.argmax(axis=1), np.diff(np.append(at, len(of))))
        byte = part[np.arange(len(part)), branch]
        sort = np.lexsort((byte, of))
        order[open_] = order[open_][sort]
        byte = byte[sort]
        split = np.append(True, (of[1:] != of[:-1]) | (byte[1:] != byte[:-1]))
        new[open_] |= split
        # A group that branched may branch again further on; one that did not is of equal strings.
        still = np.repeat(branches, np.diff(np.append(at, len(of))))
        group = np.cumsum(new) - 1
        open_ = open_[still]
        open_ = open_[np.bincount(group)[group[open_]] > 1]
    return order, new


def repeated(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether an equal string has a smaller id."""
    order, new = blind_tries(rows, *shallow_sort(rows))
    at = np.flatnonzero(new)
    least = np.repeat(np.minimum.reduceat(ids[order], at), np.diff(np.append(at, len(order))))
    out = np.zeros(len(rows), bool)
    out[order] = ids[order] > least
    return out


# Blocks ---------------------------------------------------------------------------------------------

BLOCKS = "block string, bytes long, ids array<long>, sizes array<long>, data binary, rest binary"


@lean
def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task in blocks, each one row with its texts, and all further columns, compressed."""
    from pyspark import TaskContext

    from pitchlake.llm.text import blocks

    number, task = 0, TaskContext.get().partitionId()
    held: list[tuple[np.ndarray, np.ndarray, pa.RecordBatch]] = []

    def row() -> pa.RecordBatch:
        nonlocal number
        number += 1
        data = np.concatenate([x for x, _, _ in held])
        sizes = np.concatenate([x for _, x, _ in held])
        rest = pa.Table.from_batches([x for *_, x in held])
        ids = rest.column(0).to_pylist()
        packed = pa.compress(data.tobytes(), "zstd", asbytes=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{task}-{number}"]), pa.array([len(data)]), pa.array([ids], pa.list_(pa.int64())),
             pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([packed], pa.binary()),
             pa.array([_packed(rest)], pa.binary())],
            ["block", "bytes", "ids", "sizes", "data", "rest"],
        )

    for batch in batches:
        data, offsets = texts(batch.column(1))
        rest = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1).is_null(), *batch.columns[2:]], [str(i) for i in range(batch.num_columns)]
        )
        for first, last in blocks(offsets, BLOCK):
            held.append((data[offsets[first]: offsets[last]], np.diff(offsets[first: last + 1]), rest.slice(first, last - first)))
            if sum(len(x) for x, _, _ in held) >= BLOCK // 2:
                yield row()
                held = []
    if held:
        yield row()


def _packed(rest: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rest)
    return sink.getvalue().to_pybytes()


class Block:
    """A block's texts, their spans, and each distinct span once, in order of bucket, anchor and span."""

    def __init__(self, row: dict, buckets: int) -> None:
        self.name = row["block"]
        self.data = np.frombuffer(pa.decompress(row["data"], row["bytes"], "zstd", asbytes=True), np.uint8) if row["bytes"] else np.zeros(0, np.uint8)
        self.offsets = np.append(0, np.cumsum(np.array(row["sizes"], np.int64)))
        self.ids = np.array([NOBODY if i is None else i for i in row["ids"]], np.int64)
        self.known = np.array([i is not None for i in row["ids"]], bool)
        self.spans = found = spans(self.data, self.offsets, self.known)
        bucket = ((found.anchor >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((found.span, found.anchor, bucket))
        a, s, b = found.anchor[order], found.span[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
        self.at = np.flatnonzero(new)
        self.ordinal = np.empty(len(order), np.int64)
        self.ordinal[order] = np.cumsum(new) - 1
        self.anchor, self.span, self.bucket = a[new], s[new], b[new]
        owner = self.ids[found.doc][order]
        self.least = np.minimum.reduceat(owner, self.at) if len(order) else owner
        # An occurrence of each distinct span in the document of its smallest id.
        if len(order):
            size = np.diff(np.append(self.at, len(order)))
            mine = np.flatnonzero(owner == np.repeat(self.least, size))
            self.example = order[mine[np.searchsorted(mine, self.at)]]
        else:
            self.example = order


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def _low(x: np.ndarray, size: int) -> bytes:
    """The lowest bytes of each number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _high(x: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(x) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(x, np.uint8).reshape(-1, size)
    return out.view("<u8")[:, 0]


SENT = "bucket long, block string, base long, anchors binary, spans binary, least array<long>, which binary"


@lean
def _send(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        block = Block(row, buckets)
        cut = np.flatnonzero(np.append(True, block.bucket[1:] != block.bucket[:-1])) if len(block.bucket) else []
        stop = np.append(cut[1:], len(block.bucket)) if len(cut) else []
        out = {name.split()[0]: [] for name in SENT.split(", ")}
        for a, b in zip(cut, stop, strict=True):
            ids, which = np.unique(block.least[a:b], return_inverse=True)
            out["bucket"].append(int(block.bucket[a]))
            out["block"].append(block.name)
            out["base"].append(int(a))
            out["anchors"].append(_low(block.anchor[a:b], 5))
            out["spans"].append(_low(block.span[a:b], 6))
            out["least"].append(ids.tolist())
            out["which"].append(which.astype(np.uint32 if len(ids) > 65535 else np.uint16).tobytes())
        yield pa.RecordBatch.from_pydict(out, pa.schema([
            ("bucket", pa.int64()), ("block", pa.string()), ("base", pa.int64()), ("anchors", pa.binary()),
            ("spans", pa.binary()), ("least", pa.list_(pa.int64())), ("which", pa.binary()),
        ]))


ANSWERS = pa.schema([("block", pa.string()), ("kind", pa.int32()), ("ordinals", pa.binary()), ("masks", pa.binary())])
GONE, WANTED, PARTLY = range(3)


def _answer(names: list[str], block: np.ndarray, ordinal: np.ndarray, kind: int, masks: np.ndarray | None = None) -> pa.Table:
    order = np.argsort(block, kind="stable")
    block, ordinal = block[order], ordinal[order].astype(np.uint32)
    cut = np.searchsorted(block, np.arange(len(names) + 1))
    used = np.flatnonzero(np.diff(cut))
    return pa.Table.from_pydict({
        "block": [names[i] for i in used], "kind": [kind] * len(used),
        "ordinals": [ordinal[cut[i]: cut[i + 1]].tobytes() for i in used],
        "masks": [masks[order][cut[i]: cut[i + 1]].astype(np.uint32).tobytes() if masks is not None else b"" for i in used],
    }, ANSWERS)


@lean
def _decide(table: pa.Table) -> pa.Table:
    """For the spans of one bucket: which are held by a smaller id, and which need their bytes compared."""
    anchors, span, least, block, ordinal = [], [], [], [], []
    names = table.column("block").to_pylist()
    for i, row in enumerate(table.to_pylist()):
        n = len(row["anchors"]) // 5
        ids = np.array(row["least"], np.int64)
        which = np.frombuffer(row["which"], np.uint32 if len(ids) > 65535 else np.uint16)
        anchors.append(_high(row["anchors"], 5))
        span.append(_high(row["spans"], 6))
        least.append(ids[which])
        block.append(np.full(n, i))
        ordinal.append(row["base"] + np.arange(n))
    anchors, span, least, block, ordinal = (np.concatenate(x) for x in (anchors, span, least, block, ordinal))
    order = np.lexsort((least, span, anchors))
    anchors, span, least, block, ordinal = (x[order] for x in (anchors, span, least, block, ordinal))
    new_anchor = np.append(True, anchors[1:] != anchors[:-1])
    new = new_anchor | np.append(True, span[1:] != span[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(new)))
    gone = least > np.repeat(least[at], size)
    # Of an anchor with several spans whose smallest ids differ, every holder of a span's smallest id is looked
    # at: rows of one id may lie in several blocks, and each of these needs the masks.
    group = (np.cumsum(new_anchor) - 1)[at]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    low, high = np.minimum.reduceat(least[at], first), np.maximum.reduceat(least[at], first)
    look = ~gone & np.repeat((low < high)[group], size)
    return pa.concat_tables([
        _answer(names, block[gone], ordinal[gone], GONE), _answer(names, block[look], ordinal[look], WANTED)
    ])


FETCHED = "part long, block string, ordinals binary, owners binary, sizes binary, bytes binary"


@lean
def _fetch(table: pa.Table, buckets: int) -> pa.Table:
    """The bytes of the wanted spans of one block, dealt by their anchors."""
    rows = table.to_pylist()
    block = Block(next(r for r in rows if r["data"] is not None), buckets)
    ordinal = np.sort(np.concatenate([np.frombuffer(r["ordinals"], np.uint32) for r in rows if r["data"] is None]).astype(np.int64))
    part = (block.anchor[ordinal] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ordinal, part = ordinal[order], part[order]
    example = block.example[ordinal]
    start, size = block.spans.first[example], block.spans.last[example] + LENGTH - block.spans.first[example]
    owner = block.least[ordinal]
    out = {name.split()[0]: [] for name in FETCHED.split(", ")}
    cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for a, b in zip(cut, np.append(cut[1:], len(part)), strict=True):
        which = np.repeat(start[a:b] - np.append(0, np.cumsum(size[a:b])[:-1]), size[a:b]) + np.arange(size[a:b].sum())
        out["part"].append(int(part[a]))
        out["block"].append(block.name)
        out["ordinals"].append(ordinal[a:b].astype(np.uint32).tobytes())
        out["owners"].append(owner[a:b].tobytes())
        out["sizes"].append(size[a:b].astype(np.uint8).tobytes())
        out["bytes"].append(pa.compress(block.data[which].tobytes(), "zstd", asbytes=True))
    return pa.Table.from_pydict(out, pa.schema([
        ("part", pa.int64()), ("block", pa.string()), ("ordinals", pa.binary()), ("owners", pa.binary()),
        ("sizes", pa.binary()), ("bytes", pa.binary()),
    ]))


WINDOWS_AT_ONCE = 1 << 18


@lean
def _compare(table: pa.Table) -> pa.Table:
    """Masks of the windows of the fetched spans that a smaller id holds."""
    rows = table.to_pylist()
    names = [r["block"] for r in rows]
    ordinal = np.concatenate([np.frombuffer(r["ordinals"], np.uint32) for r in rows])
    owner = np.concatenate([np.frombuffer(r["owners"], np.int64) for r in rows])
    size = [np.frombuffer(r["sizes"], np.uint8).astype(np.int64) for r in rows]
    block = np.repeat(np.arange(len(rows)), [len(s) for s in size])
    data = np.frombuffer(b"".join(
        pa.decompress(r["bytes"], int(s.sum()), "zstd", asbytes=True) for r, s in zip(rows, size, strict=True)
    ), np.uint8)
    size = np.concatenate(size)
    start = np.cumsum(size) - size
    count = size - LENGTH + 1
    item = np.repeat(np.arange(len(size)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = start[item] + step
    suffix = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    # Equal windows have equal hashes, so what is sorted at once can be cut by hash.
    power, inverse = _powers(_room(len(data)))
    running = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)]))
    piece = mix((running[at + LENGTH] - running[at]) * inverse[at]) % np.uint64(max(1, len(at) // WINDOWS_AT_ONCE + 1))
    hit = np.zeros(len(at), bool)
    for p in range(int(piece.max(initial=0)) + 1):
        mine = np.flatnonzero(piece == p)
        if len(mine):
            hit[mine] = repeated(suffix[at[mine]], owner[item[mine]])
    masks = np.bincount(item[hit], 2.0 ** step[hit], len(size)).astype(np.uint32)
    found = np.flatnonzero(masks)
    return _answer(names, block[found], ordinal[found], PARTLY, masks[found])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _covered(rows: list[dict], block: Block) -> np.ndarray:
    """Whether each byte of a block goes, by the answers to its spans."""
    found, count = block.spans, len(block.anchor)
    gone, mask = np.zeros(count, bool), np.zeros(count, np.uint32)
    for r in rows:
        if r["data"] is None:
            ordinal = np.frombuffer(r["ordinals"], np.uint32)
            if r["kind"] == GONE:
                gone[ordinal] = True
            else:
                mask[ordinal] = np.frombuffer(r["masks"], np.uint32)
    owner = block.ids[found.doc]
    whole = gone[block.ordinal] | (owner > block.least[block.ordinal])
    edge = np.zeros(len(block.data) + 1, np.int32)
    np.add.at(edge, found.first[whole], 1)
    np.add.at(edge, found.last[whole] + LENGTH, -1)
    partly = np.flatnonzero(~whole & (mask[block.ordinal] > 0))
    for step in range(NEAR):
        some = partly[(mask[block.ordinal[partly]] >> np.uint32(step)) & np.uint32(1) == 1]
        np.add.at(edge, found.first[some] + step, 1)
        np.add.at(edge, found.first[some] + step + LENGTH, -1)
    return np.cumsum(edge[:-1]) > 0


def _remaining(block: Block, covered: np.ndarray) -> list[bytes]:
    return [block.data[a:b][~covered[a:b]].tobytes() for a, b in zip(block.offsets[:-1], block.offsets[1:], strict=True)]


def _open(table: pa.Table, buckets: int) -> tuple[dict, Block, np.ndarray]:
    rows = table.to_pylist()
    row = next(r for r in rows if r["data"] is not None)
    block = Block(row, buckets)
    return row, block, _covered(rows, block)


@lean
def _digests(table: pa.Table, buckets: int) -> pa.Table:
    _, block, covered = _open(table, buckets)
    rise = covered.copy()
    rise[1:] &= ~covered[:-1]
    inner = block.offsets[:-1][block.offsets[:-1] < len(covered)]
    rise[inner] = covered[inner]
    total, starts = np.append(0, np.cumsum(covered)), np.append(0, np.cumsum(rise))
    return pa.Table.from_pydict({
        "doc_id": pa.array([int(i) if k else None for i, k in zip(block.ids, block.known, strict=True)], pa.int64()),
        "n_bytes": pa.array(np.diff(block.offsets)),
        "n_removed": pa.array(total[block.offsets[1:]] - total[block.offsets[:-1]]),
        "n_spans": pa.array(starts[block.offsets[1:]] - starts[block.offsets[:-1]]),
        "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in _remaining(block, covered)], pa.string()),
    })


@lean
def _documents(table: pa.Table, buckets: int, names: list[str]) -> pa.Table:
    """The block's documents with what remains of their texts; a character cut in two goes whole."""
    row, block, covered = _open(table, buckets)
    rest = pa.ipc.open_stream(row["rest"]).read_all()
    kept = [x.decode(errors="ignore") for x in _remaining(block, covered)]
    text = pa.array(kept, pa.string(), mask=rest.column(1).to_numpy().astype(bool))
    return pa.Table.from_arrays([text, *rest.columns[2:]], names)


def _with_blocks(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of a block and of its answers under each other, for grouping by block."""
    none = F.lit(None)
    own = blocks.select(
        "block", "bytes", "ids", "sizes", "data", "rest", none.cast("int").alias("kind"), none.cast("binary").alias("ordinals"), none.cast("binary").alias("masks")
    )
    return own.unionByName(answers, allowMissingColumns=True)


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt, buckets = _judged(rows)
    return dealt.applyInArrow(lambda t: _digests(t, buckets), RESULT)


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents``, all their columns, with what remains of their texts (null stays null)."""
    others = [c for c in documents.columns if c != text]
    rows = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    dealt, buckets = _judged(rows)
    schema = T.StructType([documents.schema[c] for c in [text, *others]])
    made = dealt.applyInArrow(lambda t: _documents(t, buckets, [text, *others]), schema)
    return made.select(*documents.columns)


def _judged(rows: DataFrame):
    """Blocks with their answers, grouped by block, and the number of buckets; rows begin with id and text."""
    blocks = written(rows.mapInArrow(_deal, BLOCKS), "suffix-blocks")
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, total // BUCKET_BYTES)
    sent = blocks.drop("rest").mapInArrow(lambda b: _send(b, buckets), SENT)
    answers = written(
        sent.groupBy("bucket").applyInArrow(_decide, "block string, kind int, ordinals binary, masks binary"), "suffix-answers"
    )
    wanted = answers.where(F.col("kind") == WANTED)
    asked = wanted.select("block").distinct()
    light = blocks.withColumn("rest", F.lit(None).cast("binary")).join(asked, "block", "left_semi")
    fetched = _with_blocks(light, wanted).groupBy("block").applyInArrow(lambda t: _fetch(t, buckets), FETCHED)
    partly = fetched.groupBy("part").applyInArrow(_compare, "block string, kind int, ordinals binary, masks binary")
    told = answers.where(F.col("kind") == GONE).unionByName(written(partly, "suffix-partly"))
    return _with_blocks(blocks, told).groupBy("block"), buckets
