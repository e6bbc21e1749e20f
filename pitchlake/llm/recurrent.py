"""Scoring by a gated recurrent language model in numpy, beside an add-one unigram base.

Counts of all tokens of all training texts come from Spark. The ``HEAD`` most frequent at most have their counts
broadcast (a fixed size); no other token can hold more than its share of the rest, so their counts are
joined by hash without a hot key. The network knows the ``WORDS`` most frequent tokens; all others are one rare
event, times their smoothed share of the rare tokens. Its softmax is factored into classes of
neighbouring frequency. Training is truncated backpropagation: first on about ``WARM_TEXTS`` texts in one
task, so that all workers start alike, then every task goes over its whole part of the training texts, and the
weights meet by tree averaging, weighted by tokens. In scoring the state is carried through windows
from a text's first token to its end, so the score is that of the complete document.

Defined results
    Null or empty text: the end token alone. Nothing to learn from: every token counts as rare, and
    both scores are 0. Repeated rows are scored each; rows of one id with different texts too. Null
    doc_id: in the fold of the empty text. No rows: no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import sampling
from pitchlake.llm.store import written
from pitchlake.llm.text import SPACED, blocks, texts, tokens

HEAD = 1 << 16
CLASSES, IN_CLASS = 32, 32
WORDS = CLASSES * IN_CLASS  # the last one is the rare event
RARE = WORDS - 1
HIDDEN = 16
LANES, STEPS = 512, 32  # of a training window
WARM_LANES = 64
WARM_TEXTS = 2000
RATE, WARM_RATE = 0.002, 0.01
FAN_IN = 64
END = np.uint64(0x0E0D)
TRAIN_BLOCK, SCORE_BLOCK = 6 << 20, 12 << 20
SHAPES = {
    "x": (WORDS, 3 * HIDDEN), "u": (HIDDEN, 2 * HIDDEN), "v": (HIDDEN, HIDDEN),
    "c": (HIDDEN, CLASSES), "cb": (CLASSES,), "w": (CLASSES, HIDDEN, IN_CLASS), "wb": (CLASSES, IN_CLASS),
}
SIZES = {k: math.prod(s) for k, s in SHAPES.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)
    return x


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def start(counts: np.ndarray, seed: int = 3) -> np.ndarray:
    """Weights to begin with, flat; the biases say the shares of the words."""
    rng = np.random.default_rng(seed)
    p = {k: rng.normal(0, 0.15, s) for k, s in SHAPES.items()}
    share = (counts + 1.0).reshape(CLASSES, IN_CLASS)
    p["cb"] = np.log(share.sum(axis=1) / share.sum())
    p["wb"] = np.log(share / share.sum(axis=1, keepdims=True))
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float32)


class Gru:
    """Forward and backward over windows; all weights are views of one flat array."""

    def __init__(self, flat: np.ndarray) -> None:
        self.flat = flat
        self.p, at = {}, 0
        for k, s in SHAPES.items():
            self.p[k] = flat[at: at + SIZES[k]].reshape(s)
            at += SIZES[k]

    def step(self, h: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
        x = self.p["x"][word]
        gates = h @ self.p["u"]
        gates += x[:, : 2 * HIDDEN]
        gates = _sigmoid(gates)
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = (r * h) @ self.p["v"]
        n += x[:, 2 * HIDDEN:]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, z, r, n

    def log_p(self, h: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each word after its state."""
        of = word // IN_CLASS
        out = np.log(_softmax(h @ self.p["c"] + self.p["cb"])[np.arange(len(h)), of] + 1e-30)
        order = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[order], np.arange(CLASSES + 1))
        for k in range(CLASSES):
            mine = order[cut[k]: cut[k + 1]]
            if len(mine):
                q = _softmax(h[mine] @ self.p["w"][k] + self.p["wb"][k])
                out[mine] += np.log(q[np.arange(len(mine)), word[mine] % IN_CLASS] + 1e-30)
        return out

    def gradient(self, h: np.ndarray, inputs: np.ndarray, keep: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean loss over a window (steps by lanes), and the state after it."""
        steps, lanes = inputs.shape
        states = np.empty((steps, lanes, HIDDEN), np.float32)
        kept = []
        for t in range(steps):
            before = h * keep[t][:, None]
            h, z, r, n = self.step(before, inputs[t])
            states[t] = h
            kept.append((before, z, r, n))
        g = Gru(np.zeros_like(self.flat)).p
        back = self._output(states.reshape(-1, HIDDEN), target.ravel(), g).reshape(states.shape)
        gates = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
        carried = np.zeros((lanes, HIDDEN), np.float32)
        ut, vt = self.p["u"].T.copy(), self.p["v"].T.copy()
        for t in range(steps - 1, -1, -1):
            before, z, r, n = kept[t]
            d = back[t] + carried
            a = gates[t]
            dn = d * (1 - z) * (1 - n * n)
            a[:, 2 * HIDDEN:] = dn
            reset = dn @ vt
            a[:, :HIDDEN] = d * (before - n) * z * (1 - z)
            a[:, HIDDEN: 2 * HIDDEN] = reset * before * r * (1 - r)
            carried = d * z + reset * r + a[:, : 2 * HIDDEN] @ ut
            carried *= keep[t][:, None]
        flat_gates = gates.reshape(-1, 3 * HIDDEN)
        before = np.concatenate([k[0] for k in kept])
        g["u"] += before.T @ flat_gates[:, : 2 * HIDDEN]
        g["v"] += (before * np.concatenate([k[2] for k in kept])).T @ flat_gates[:, 2 * HIDDEN:]
        word = inputs.ravel()
        order = np.argsort(word, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(word[order]) != 0))
        g["x"][word[order][at]] = np.add.reduceat(flat_gates[order], at, axis=0)
        flat = np.concatenate([g[k].ravel() for k in SHAPES]) / (steps * lanes)
        return flat, h

    def _output(self, h: np.ndarray, word: np.ndarray, g: dict) -> np.ndarray:
        of = word // IN_CLASS
        d = _softmax(h @ self.p["c"] + self.p["cb"])
        d[np.arange(len(h)), of] -= 1
        g["c"] += h.T @ d
        g["cb"] += d.sum(axis=0)
        back = d @ self.p["c"].T
        order = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[order], np.arange(CLASSES + 1))
        for k in range(CLASSES):
            mine = order[cut[k]: cut[k + 1]]
            if len(mine):
                own = h[mine]
                d = _softmax(own @ self.p["w"][k] + self.p["wb"][k])
                d[np.arange(len(mine)), word[mine] % IN_CLASS] -= 1
                g["w"][k] += own.T @ d
                g["wb"][k] += d.sum(axis=0)
                back[mine] += d @ self.p["w"][k].T
        return back


class Trainer:
    """Adam over the windows of a stream of words."""

    def __init__(self, flat: np.ndarray, lanes: int, rate: float) -> None:
        self.model = Gru(flat.copy())
        self.m, self.s = np.zeros_like(flat), np.zeros_like(flat)
        self.lanes, self.rate, self.steps, self.seen = lanes, rate, 0, 0

    def learn(self, words: np.ndarray, end: int) -> None:
        """Words of whole texts, each closed by ``end``; the stream is laid out in lanes."""
        self.seen += len(words)
        lanes = max(1, min(self.lanes, len(words) // STEPS))
        length, extra = divmod(len(words), lanes)
        # The first lanes are one word longer, so that no word is left over.
        start = np.arange(lanes) * length + np.minimum(np.arange(lanes), extra)
        before = np.append(end, words).astype(words.dtype)  # of each word
        h = np.zeros((lanes, HIDDEN), np.float32)
        for t in range(0, length, STEPS):
            h = self._window(h, start + np.arange(t, min(t + STEPS, length))[:, None], words, before, end)
        if extra:
            self._window(h[:extra], start[None, :extra] + length, words, before, end)

    def _window(self, h: np.ndarray, at: np.ndarray, words: np.ndarray, before: np.ndarray, end: int) -> np.ndarray:
        """Learn the words at the given places (steps by lanes); the state after them."""
        x = before[at]
        grad, h = self.model.gradient(h, x, (x != end).astype(np.float32), words[at])
        self._update(grad)
        return h

    def _update(self, grad: np.ndarray) -> None:
        size = float(np.linalg.norm(grad))
        if size > 1:
            grad /= size
        self.steps += 1
        self.m += 0.1 * (grad - self.m)
        self.s += 0.01 * (grad * grad - self.s)
        rate = self.rate * math.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        self.model.flat -= rate * self.m / (np.sqrt(self.s) + 1e-8)


def text_scores(model: Gru, words: np.ndarray, bounds: np.ndarray, end: int, lanes: int = 256) -> np.ndarray:
    """Natural log-likelihood of each whole text; ``words`` of text i: bounds[i] to bounds[i + 1]."""
    size = np.diff(bounds)
    rows = len(size)
    out = np.zeros(rows)
    if not rows:
        return out
    lanes = int(max(1, min(lanes, rows, -(-size.sum() // size.max()))))
    # The longest first, each to the lane that ends first; so lanes end at about the same step.
    import heapq

    heap = [(0, i) for i in range(lanes)]
    placed: list[list[int]] = [[] for _ in range(lanes)]
    for i in np.argsort(-size, kind="stable"):
        used, lane = heapq.heappop(heap)
        placed[lane].append(int(i))
        heapq.heappush(heap, (used + int(size[i]), lane))
    placed.sort(key=lambda own: -int(size[own].sum()))
    length = np.array([int(size[own].sum()) for own in placed])
    target = np.full((length[0], lanes), end, np.int32)
    owner = np.zeros((length[0], lanes), np.int32)
    inputs = np.full((length[0], lanes), end, np.int32)
    for lane, own in enumerate(placed):
        at = 0
        for i in own:
            n = int(size[i])
            target[at: at + n, lane] = words[bounds[i]: bounds[i + 1]]
            owner[at: at + n, lane] = i
            at += n
        inputs[1:at, lane] = target[: at - 1, lane]
    open_ = np.searchsorted(-length, -np.arange(length[0]), "left")  # lanes longer than t
    h = np.zeros((lanes, HIDDEN), np.float32)
    window = 64
    for first in range(0, length[0], window):
        states, wanted, whose = [], [], []
        for t in range(first, min(first + window, length[0])):
            n = open_[t]
            word = inputs[t, :n]
            h = model.step(h[:n] * (word != end)[:, None], word)[0]
            states.append(h)
            wanted.append(target[t, :n])
            whose.append(owner[t, :n])
        found = model.log_p(np.concatenate(states), np.concatenate(wanted))
        out += np.bincount(np.concatenate(whose), found, rows)
    return out


class Head:
    """Counts of the most frequent tokens, and the word of each in the model, by hash."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        by_count = np.lexsort((hashes, -counts))
        word = np.full(len(hashes), RARE)
        word[by_count[:RARE]] = np.arange(min(RARE, len(hashes)))
        order = np.argsort(hashes)
        self.hashes, self.counts, self.word = hashes[order], counts[order], word[order]
        self.end = int(self.lookup(np.array([END]))[1][0])

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count, or 0 where it is not among these, and word of each token."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.full(len(hashes), RARE)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        there = self.hashes[at] == hashes
        return np.where(there, self.counts[at], 0), np.where(there, self.word[at], RARE)

    def word_counts(self, total: int) -> np.ndarray:
        out = np.zeros(WORDS)
        known = self.word != RARE
        out[self.word[known]] = self.counts[known]
        out[RARE] = max(total - out.sum(), 0)
        return out


def stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text closed by the end token, and the texts' bounds."""
    found = tokens(data, offsets, SPACED)
    rows = len(offsets) - 1
    per = np.bincount(found.text, minlength=rows) + 1
    bounds = np.append(0, np.cumsum(per))
    out = np.full(bounds[-1], END)
    out[np.arange(len(found.hash)) + found.text] = found.hash
    return out, bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        for first, last in blocks(offsets, 16 << 20):
            hashes, _ = stream(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
            h, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


def head_of(counts: DataFrame) -> Head:
    """The tokens above the least count (on a fine log scale) that leaves at most ``HEAD`` of them."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    bins = sorted(((r["b"], r["k"]) for r in counts.groupBy(step.alias("b")).agg(F.count("*").alias("k")).collect()), reverse=True)
    taken, least = 0, None
    for b, k in bins:
        if taken + k > HEAD:
            break
        taken, least = taken + k, b
    if least is None:
        # Even the topmost step holds too many: a fixed number of them by hash.
        chosen = counts.where(step == bins[0][0]).orderBy("h").limit(RARE) if bins else counts
    else:
        chosen = counts.where(step >= least)
    held = chosen.select("h", "n").toArrow()
    return Head(held.column("h").to_numpy().view(np.uint64), held.column("n").to_numpy())


def _train(batches: Iterator[pa.RecordBatch], held, lanes: int, rate: float) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    head, flat = held.value
    trainer = Trainer(flat, lanes, rate)
    for batch in batches:
        data, offsets = texts(batch.column("text"))
        for first, last in blocks(offsets, TRAIN_BLOCK):
            hashes, _ = stream(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
            trainer.learn(head.lookup(hashes)[1].astype(np.int32), head.end)
    if trainer.seen:
        yield _weights(TaskContext.get().partitionId(), trainer.seen, trainer.model.flat)


def _weights(part: int, seen: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([seen], pa.int64()), pa.array([flat.astype("<f4").tobytes()], pa.binary())],
        ["part", "seen", "weights"],
    )


WEIGHTS = "part long, seen long, weights binary"


def _mean(table: pa.Table) -> pa.Table:
    seen = table.column("seen").to_numpy()
    total = sum(n * np.frombuffer(x, "<f4").astype(np.float64) for n, x in zip(seen, table.column("weights").to_pylist(), strict=True))
    return pa.Table.from_batches([_weights(table.column("part")[0].as_py(), int(seen.sum()), total / seen.sum())])


def averaged(models: DataFrame) -> np.ndarray | None:
    """Mean of all models, weighted by what each has seen, in groups of at most ``FAN_IN``."""
    models = written(models, "recurrent-weights")
    while models.count() > FAN_IN:
        models = written(
            models.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInArrow(_mean, WEIGHTS), "recurrent-weights"
        )
    left = models.toArrow()
    return np.frombuffer(_mean(left).column("weights")[0].as_py(), "<f4").copy() if len(left) else None


def learn(train: DataFrame, head: Head, total: int) -> np.ndarray:
    """Weights of the network from all texts of ``train``."""
    context = train.sparkSession.sparkContext
    flat = start(head.word_counts(total))
    count = train.count()
    share = F.pmod(F.xxhash64(F.lit("warm"), "text"), F.lit(sampling.STEPS)) < int(sampling.STEPS * min(1.0, WARM_TEXTS / max(count, 1)))
    sample = train.where(share).repartition(1).sortWithinPartitions(F.xxhash64("text"))
    begun = averaged(sample.mapInArrow(_task(context.broadcast((head, flat)), WARM_LANES, WARM_RATE), WEIGHTS))
    flat = flat if begun is None else begun
    done = averaged(train.mapInArrow(_task(context.broadcast((head, flat)), LANES, RATE), WEIGHTS))
    return flat if done is None else done


def _task(held, lanes: int, rate: float):
    return lambda batches: _train(batches, held, lanes, rate)


def lm_scores(
    documents: DataFrame, held_parts: int = 7, held_part: int = 2, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    held_out = sampling.fold("doc_id", held_parts) == held_part
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    train = rows.where(~held_out).select("text")
    counts = written(
        train.mapInArrow(_count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "recurrent-counts"
    )
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = head_of(counts)
    flat = learn(train, head, total)
    held = documents.sparkSession.sparkContext.broadcast((head, flat))
    scored = written(
        rows.select("doc_id", F.xxhash64("text").alias("same"), "text").mapInArrow(_scorer(held), f"doc_id {kind}, {SCORED}"),
        "recurrent-scored",
    )
    # Tokens outside the head: their counts by a join on the hash.
    rest = scored.select("doc_id", "same", F.explode(F.arrays_zip("rest", "times")).alias("t")).select(
        "doc_id", "same", F.col("t.rest").alias("h"), F.col("t.times").alias("times")
    ).join(counts, "h").select(
        "doc_id", "same", F.col("times").alias("known"), (F.col("times") * F.log10(F.col("n") + 1)).alias("logs")
    )
    none = F.lit(0).cast("long")
    own = scored.select("doc_id", "same", "n_tokens", "known", "base", "model", "rare", F.lit(1).cast("long").alias("copies"), F.lit(0.0).alias("logs"))
    more = rest.select(
        "doc_id", "same", none.alias("n_tokens"), "known", F.lit(0.0).alias("base"), F.lit(0.0).alias("model"), none.alias("rare"), none.alias("copies"), "logs"
    )
    found = own.unionByName(more).groupBy("doc_id", "same").agg(
        *[F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "model", "rare", "copies", "logs")]
    )
    # Equal rows were added up; each gets its share.
    per = {c: F.col(c) / F.col("copies") for c in ("base", "model", "logs")}
    tokens_, rare = F.col("n_tokens") / F.col("copies"), F.col("rare") / F.col("copies")
    in_model = float((head.counts[head.word != RARE] + 1).sum())
    rare_total = math.log10(max(total + types + 1 - in_model, 1.0))
    return found.select(
        "doc_id", held_out.alias("held_out"), tokens_.cast("long").alias("n_tokens"),
        F.round(F.col("known") / F.col("copies")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (per["base"] + per["logs"] - tokens_ * F.lit(math.log10(total + types + 1))).alias("base_score"),
        (per["model"] + per["logs"] - rare * F.lit(rare_total)).alias("score"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


SCORED = "same long, n_tokens long, known long, base double, model double, rare long, rest array<long>, times array<long>"


def _scorer(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, flat = held.value
        model = Gru(flat)
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            for first, last in blocks(offsets, SCORE_BLOCK):
                made = _scored(head, model, data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("same"), *made],
                    ["doc_id", "same", "n_tokens", "known", "base", "model", "rare", "rest", "times"],
                )

    return run


def _scored(head: Head, model: Gru, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    hashes, bounds = stream(data, offsets)
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))
    count, word = head.lookup(hashes)
    logs = np.log10(count + 1.0)
    in_head, rare = count > 0, word == RARE
    base = np.bincount(row[in_head], logs[in_head], rows).astype(float)
    likely = np.zeros(rows)
    if len(head.hashes):
        likely = text_scores(model, word.astype(np.int32), bounds, head.end) / math.log(10)
    # Rare tokens of the head bring their own share here, the others after the join.
    mine = in_head & rare
    likely += np.bincount(row[mine], logs[mine], rows)
    base_only = np.bincount(row[in_head], minlength=rows)
    out = np.flatnonzero(~in_head)
    order = out[np.lexsort((hashes[out], row[out]))]
    new = np.flatnonzero(np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1]))) if len(order) else order
    times = np.diff(np.append(new, len(order)))
    rest, rest_row = hashes[order][new].view(np.int64), row[order][new]
    at = pa.array(np.searchsorted(rest_row, np.arange(rows + 1)).astype(np.int32))
    return [
        pa.array(np.diff(bounds)), pa.array(base_only.astype(np.int64)), pa.array(base), pa.array(likely),
        pa.array(np.bincount(row[rare], minlength=rows).astype(np.int64)),
        pa.ListArray.from_arrays(at, pa.array(rest)), pa.ListArray.from_arrays(at, pa.array(times.astype(np.int64))),
    ]
