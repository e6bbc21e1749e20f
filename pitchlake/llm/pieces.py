"""SentencePiece encoding and decoding with a BPE vocabulary, giant documents by a max-plus parallel scan.

A segmentation is what the BPE merges give exactly where every two neighbouring pieces, merged alone, stay the
two pieces. So encoding is a best path: a state is a position with the piece that ends there, a step adds
a piece, and its weight is 0 where the pair stays apart and minus infinity where it doesn't. In a text one
path alone has a finite weight. Texts of up to ``GIANT`` characters take the path unit by unit (pieces
never cross from a word to the space before the next); each distinct unit is solved once a worker.

Giant texts are cut every ``CHUNK`` characters, wherever that falls. Each chunk yields the transfer matrix
from the states in which a path can enter it to those in which it can leave, in the max-plus semiring. The
matrices of a document are multiplied in order (the product is associative), which leaves one state at every
boundary; then all chunks are traced back on their own.

Defined results
    The file must hold a BPE model with byte fallback, a dummy space in front and no other normalisation,
    and pieces with a space only in front; others are refused. Null text: null pieces. Empty text: no pieces.
    Decoding a null: null; ids out of range: an error; control ids: nothing. The mark U+2581 in a text
    comes back as a space, as in the library. Repeated rows are encoded each. No rows: no rows.
    Further columns are kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.store import written
from pitchlake.llm.text import blocks, hash_ranges, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
GIANT = 1 << 16
CHUNK = 1 << 14
CACHED = 1 << 20  # distinct units kept by a worker
PAIRS = 1 << 19  # pairs of pieces kept by a worker
START, UNKNOWN = -1, -2


class Pieces:
    """The vocabulary, and which pairs of pieces stay apart."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        names = [model.id_to_piece(i) for i in ids]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in ids]
        self.ids = {names[i]: i for i in ids if not special[i]}
        self.score = {names[i]: model.get_score(i) for i in ids if not special[i]}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        if any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in self.ids):
            raise ValueError("pieces with a space inside are not supported")
        if not all(model.is_byte(b) for b in self.bytes) or model.encode("a  b\n", out_type=str)[:1] != [MARK + "a"]:
            raise ValueError("the model must have byte fallback and a dummy space in front")
        self.names = names
        self.pairs: dict[int, bool] = {}
        # Pieces that the merges never make out of their own characters cannot occur.
        self.ids = {p: i for p, i in self.ids.items() if self.merged(p) == [p]}
        self.tree: dict = {}  # character -> [piece that ends here, further characters]
        for p, i in self.ids.items():
            node, below = None, self.tree
            for c in p:
                node = below.setdefault(c, [None, {}])
                below = node[1]
            node[0] = i
        shown = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else names[i].replace(MARK, " ").encode() for i in ids]
        for b, i in enumerate(self.bytes):
            shown[i] = bytes([b])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_at = np.append(0, np.cumsum([len(x) for x in shown]))
        self.spaced = np.array([n.startswith(MARK) and not special[i] for i, n in enumerate(names)])

    def merged(self, text: str) -> list[str]:
        """What the merges make of a short text: always the pair of best score, the first of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: int, right: int) -> bool:
        """Whether two pieces stay two: the weight of the step is 0, else minus infinity."""
        if left < 0 or right < 0:
            return True
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            a, b = self.names[left], self.names[right]
            found = self.pairs[key] = self.merged(a + b) == [a, b]
        return found

    def paths(self, text: str, first: int, entry: int, last: int) -> list[int | None]:
        """From piece ``entry`` ending at ``first``: the piece that ends at each position up to ``last``, or None."""
        pairs, apart = self.pairs, self.apart
        if len(pairs) > PAIRS:
            pairs.clear()
        ends: list[int | None] = [None] * (last + 1)
        ends[first] = entry
        for j in range(first, last):
            before = ends[j]
            if before is None:
                continue
            node = self.tree.get(text[j])
            if node is None:
                ends[j + 1] = UNKNOWN  # a character without a piece stays apart from all
                continue
            i = j + 1
            key = before << 32
            while True:
                piece = node[0]
                if piece is not None and ends[i] is None:
                    if before < 0:
                        ends[i] = piece
                    else:
                        ok = pairs.get(key | piece)
                        if ok is None:
                            ok = apart(before, piece)
                        if ok:
                            ends[i] = piece
                if i == last:
                    break
                node = node[1].get(text[i])
                if node is None:
                    break
                i += 1
        return ends

    def size(self, piece: int) -> int:
        return len(self.names[piece]) if piece >= 0 else 1

    def trace(self, text: str, ends: list[int | None], first: int, last: int) -> list[int]:
        """Ids of the pieces from ``first`` to ``last``."""
        out: list[int] = []
        while last > first:
            piece = ends[last]
            before = last - self.size(piece)
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.bytes[b] for b in reversed(text[before:last].encode())]
            last = before
        return out[::-1]

    def unit(self, text: str) -> list[int]:
        return self.trace(text, self.paths(text, 0, START, len(text)), 0, len(text))

    # Chunks of giant texts -----------------------------------------------------------------------

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """(end, piece) of all pieces that begin before ``at`` and end there or beyond."""
        if at == 0:
            return [(0, START)]
        found = []
        for j in range(max(0, at - self.longest), at):
            for i in range(at, min(j + self.longest, len(text)) + 1):
                piece = self.ids.get(text[j:i])
                if piece is None and j == i - 1:
                    piece = UNKNOWN
                if piece is not None:
                    found.append((i, piece))
        return found

    def transfer(self, text: str, first: int, last: int) -> list[list[int]]:
        """Finite entries [end, piece, end', piece'] of a chunk's matrix; positions as in ``text``."""
        leave = set(self.states(text, last)) if last < len(text) else None
        reach = min(last + self.longest - 1, len(text)) if leave is not None else last
        known: list[tuple[list[int | None], list[tuple[int, int]]]] = []
        out = []
        for at, piece in self.states(text, first):
            exits = None
            # Where two paths agree over the longest piece's length they are one from there on.
            short = min(at + 4 * self.longest, reach)
            ends = self.paths(text, at, piece, short)
            for other, theirs in known:
                if short < last and ends[short - self.longest + 1:] == other[short - self.longest + 1: short + 1]:
                    exits = theirs
                    break
            if exits is None:
                ends = self.paths(text, at, piece, reach)
                exits = [
                    (i, ends[i]) for i in range(last, reach + 1)
                    if ends[i] is not None and (i == last or i - self.size(ends[i]) < last) and (leave is None or (i, ends[i]) in leave)
                ]
                known.append((ends, exits))
            out += [[at, piece, i, p] for i, p in exits]
        return out


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Units:
    """Ids of the distinct units met so far, by their hash."""

    def __init__(self, vocabulary: Pieces) -> None:
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where those of each text begin."""
        if len(self.known) > CACHED:
            self._clear()
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        filled = np.flatnonzero(np.diff(offsets))
        heads = offsets[:-1][filled]
        space, line = data == 32, data == 10
        new = line.copy()
        new[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        new[heads] = True
        at = np.flatnonzero(new)
        end = np.append(at[1:], n)
        value = hash_ranges(data, at, end)
        head = np.zeros(n, bool)
        head[heads] = True
        head = head[at]
        value[head] ^= np.uint64(0x5851F42D4C957F2D)  # a text's first unit has the dummy space
        distinct, first, which = np.unique(value, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        met = np.zeros(len(distinct), bool)
        met[place < len(self.known)] = self.known[place[place < len(self.known)]] == distinct[place < len(self.known)]
        missing = np.flatnonzero(~met)
        if len(missing):
            made = []
            for k in first[missing]:
                text = data[at[k]: end[k]].tobytes().decode().replace(" ", MARK)
                made.append(self.vocabulary.unit(MARK + text if head[k] else text))
            size = np.array([len(x) for x in made], np.int64)
            start = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate([self.flat, np.array([i for x in made for i in x], np.int32)])
            self.start = np.insert(self.start, place[missing], start)
            self.size = np.insert(self.size, place[missing], size)
            self.known = np.insert(self.known, place[missing], distinct[missing])
            place = np.searchsorted(self.known, distinct)
        start, size = self.start[place][which], self.size[place][which]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(start - (ends - size), size) + np.arange(ends[-1])]
        unit_of = np.searchsorted(at, offsets)
        return ids, np.append(0, ends)[unit_of]


@lru_cache(maxsize=2)
def solved(path: str) -> Units:
    """The units that this worker has met in its tasks so far."""
    return Units(pieces(path))


def _with(batch: pa.RecordBatch, column: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])


def _lists(ids: np.ndarray, bounds: np.ndarray, valid: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()), mask=pa.array(~valid))


def _encoder(path: str, text: str, column: str, checked: str | None, keep_text: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, units = pieces(path), solved(path)
        for batch in batches:
            data, offsets = texts(batch.column(text))
            valid = batch.column(text).is_valid().to_numpy(zero_copy_only=False)
            for first, last in blocks(offsets, 2 << 20):
                part = data[offsets[first]: offsets[last]]
                ids, bounds = units.encode(part, offsets[first: last + 1] - offsets[first])
                found = _lists(ids, bounds, valid[first:last])
                rows = batch.slice(first, last - first)
                made = _with(rows if keep_text else rows.drop_columns([text]), found, column)
                yield _with(made, _returns(vocabulary, rows.column(text), found), checked) if checked else made

    return encode


def _returns(vocabulary: Pieces, text: pa.Array, found: pa.Array) -> pa.Array:
    """Whether each text comes back from its pieces; the mark in a text comes back as a space."""
    if pc.any(pc.match_substring(text, MARK)).as_py():
        text = pc.replace_substring(text, MARK, " ")
    return pc.fill_null(pc.equal(text.cast(pa.string()), decoded(vocabulary, found)), True)


def encode(
    documents: DataFrame, model: str = MODEL, text: str = "text", column: str = "pieces", giant: int = GIANT,
    chunk: int = CHUNK, checked: str | None = None, keep_text: bool = True,
) -> DataFrame:
    """The rows of ``documents`` with an array of piece ids more.

    With ``checked`` a boolean column of that name tells whether the pieces decode to the text (null: yes).
    Without ``keep_text`` the text column is left out. A column that already has one of these names is replaced.
    """
    documents = _without(documents, text, column, checked)
    kept = [f for f in documents.schema.fields if keep_text or f.name != text]
    more = [T.StructField(column, T.ArrayType(T.IntegerType()))]
    more += [T.StructField(checked, T.BooleanType())] if checked else []
    schema = T.StructType([*kept, *more])
    long = F.coalesce(F.length(text) > giant, F.lit(False))
    made = documents.where(~long).mapInArrow(_encoder(model, text, column, checked, keep_text), schema)
    giants = _scanned(documents.where(long), model, text, column, chunk)
    if checked:
        giants = giants.mapInArrow(
            _checker(model, text, column, checked), T.StructType([*giants.schema.fields, more[1]])
        )
    return made.unionByName(giants.select(*schema.names))


def _without(frame: DataFrame, source: str, *made: str | None) -> DataFrame:
    """The frame less the columns that an operator makes anew from ``source``."""
    names = {n.lower() for n in made if n}
    if source.lower() in names:
        raise ValueError(f"{source} is the input and cannot be made anew")
    return frame.select(*[F.col(f"`{n}`") for n in frame.columns if n.lower() not in names])


def _checker(model: str, text: str, column: str, checked: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                yield _with(row, _returns(pieces(model), row.column(text), row.column(column)), checked)

    return run


def _scanned(giants: DataFrame, model: str, text: str, column: str, chunk: int) -> DataFrame:
    """Giant texts: transfers by chunk, states by document, traces by chunk."""
    # Characters of context around a chunk.
    longest = max(64, pieces(model).longest)
    key = "scan_row"
    while key in giants.columns:
        key += "_"
    kept = written(giants.withColumn(key, F.monotonically_increasing_id()), "pieces-giant")
    whole = F.concat(F.lit(MARK), F.translate(text, " ", MARK))
    rows = kept.select(F.col(key).alias("row"), whole.alias("t"), (F.length(text) + 1).alias("n"))
    rows = rows.select("row", "t", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / chunk))).alias("c"))
    first = F.col("c") * chunk
    low = F.greatest(first - longest, F.lit(0))
    cut = written(rows.select(
        "row", "c", low.alias("low"), first.alias("first"), F.least(first + chunk, F.col("n")).alias("last"), "n",
        F.expr(f"substring(t, cast(greatest(c * {chunk} - {longest}, 0) + 1 as int), {chunk + 2 * longest})").alias("t"),
    ), "pieces-chunks")
    transfers = cut.mapInArrow(_transfers(model), "row long, c long, matrix string")
    chosen = transfers.groupBy("row").applyInArrow(_choose, "row long, c long, entry array<long>, exit array<long>")
    traced = cut.join(written(chosen, "pieces-states"), ["row", "c"]).mapInArrow(_traces(model), "row long, c long, ids array<int>")
    ids = traced.groupBy("row").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("c", "ids"))), lambda x: x["ids"])).alias(column)
    )
    return kept.join(ids.withColumnRenamed("row", key), key).drop(key)


def _transfers(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                low = r["low"]
                text = r["t"] if r["last"] < r["n"] else r["t"][: r["n"] - low]
                found = vocabulary.transfer(text, r["first"] - low, r["last"] - low)
                out.append(json.dumps([[a + low, p, b + low, q] for a, p, b, q in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("c"), pa.array(out, pa.string())], ["row", "c", "matrix"]
            )

    return run


def product(left: dict, right: dict) -> dict:
    """Max-plus product of two matrices of finite entries {from: {to: weight}}."""
    out: dict = {}
    for a, row in left.items():
        best: dict = {}
        for b, w in row.items():
            for c, v in right.get(b, {}).items():
                best[c] = max(best.get(c, -np.inf), w + v)
        if best:
            out[a] = best
    return out


def _choose(table: pa.Table) -> pa.Table:
    """The state at every boundary of one document: finite both from its start and to its end."""
    rows = sorted(table.to_pylist(), key=lambda r: r["c"])
    matrices = []
    for r in rows:
        m: dict = {}
        for a, p, b, q in json.loads(r["matrix"]):
            m.setdefault((a, p), {})[(b, q)] = 0.0
        matrices.append(m)
    ahead = [{(0, START): {(0, START): 0.0}}]
    for m in matrices:
        ahead.append(product(ahead[-1], m))
    state = next(iter(ahead[-1][(0, START)]))  # the whole text is covered by one path
    states = [state]
    for m, before in zip(reversed(matrices), reversed(ahead[:-1]), strict=True):
        state = next(s for s in before[(0, START)] if state in m.get(s, {}))
        states.append(state)
    states.reverse()
    return pa.table({
        "row": pa.array([r["row"] for r in rows], pa.int64()), "c": pa.array([r["c"] for r in rows], pa.int64()),
        "entry": pa.array([list(s) for s in states[:-1]], pa.list_(pa.int64())),
        "exit": pa.array([list(s) for s in states[1:]], pa.list_(pa.int64())),
    })


def _traces(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                at, piece = r["entry"][0] - r["low"], r["entry"][1]
                end = r["exit"][0] - r["low"]
                out.append(vocabulary.trace(r["t"], vocabulary.paths(r["t"], at, piece, end), at, end) if end > at else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("c"), pa.array(out, pa.list_(pa.int32()))], ["row", "c", "ids"]
            )

    return run


def decode(frame: DataFrame, model: str = MODEL, column: str = "pieces", text: str = "decoded") -> DataFrame:
    """The rows of ``frame`` with the text of their pieces more, in place of a column of that name."""
    frame = _without(frame, column, text)
    schema = T.StructType([*frame.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            size = np.nan_to_num(batch.column(column).value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            bounds = np.append(0, np.cumsum(size))
            for first, last in blocks(bounds, 1 << 20):
                part = batch.slice(first, last - first)
                yield _with(part, decoded(vocabulary, part.column(column)), text)

    return frame.mapInArrow(run, schema)


def decoded(vocabulary: Pieces, lists: pa.Array) -> pa.Array:
    size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(ids) and not 0 <= ids.min() <= ids.max() < len(vocabulary.names):
        raise ValueError("a piece id is out of range")
    start, length = vocabulary.shown_at[ids], np.diff(vocabulary.shown_at)[ids]
    begin = np.cumsum(size) - size
    heads = begin[size > 0]
    drop = heads[vocabulary.spaced[ids[heads]]]  # the dummy space
    start[drop] += 1
    length[drop] -= 1
    ends = np.cumsum(length)
    data = vocabulary.shown[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]
    offsets = np.append(0, ends)[np.append(begin, len(ids))]
    raw = data.tobytes()
    try:
        raw.decode()
        made = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    except UnicodeDecodeError:
        made = [raw[a:b].decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return pa.array(made, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
