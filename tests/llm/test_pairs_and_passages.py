"""Near duplicates, repeated passages, benchmark items and top-k search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pitchlake.llm import decontaminate, graph, jaccard, suffixes, text, topk
from tests.llm.conftest import edge_texts, prose


def near_copies(groups: int = 4, size: int = 9) -> list[tuple]:
    rows, rng = [], random.Random(5)
    for g in range(groups):
        words = prose(100 + g, 60 + 40 * g).split()
        for _ in range(size):
            own = list(words)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"w{rng.randint(0, 9)}"
            rows.append((1000 + len(rows), " ".join(own)))
    return rows


def jaccard_brute(pairs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in pairs:
        w = [x for x in re.split("[ \t\n\r\x0b\x0c]+", (text or "").translate(low)) if x]
        sets.append({tuple(w[i: i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    n = len(pairs)
    linked = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [pairs[j][0] for j in seen if pairs[j][0] is not None]
        out.append((pairs[i][0], min(ids) if ids else None, len(linked[i])))
    return sorted(out, key=repr)


def test_near_duplicates_equal_brute_force(documents):
    pairs = edge_texts() + near_copies()
    found = jaccard.near_duplicates(documents(pairs)).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, found), key=repr) == jaccard_brute(pairs)


def test_groups_beyond_a_block_lose_no_link(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 4)
    pairs = near_copies(2, 15)
    found = jaccard.near_duplicates(documents(pairs)).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, found), key=repr) == jaccard_brute(pairs)


def short_copies(seed: int, groups: int) -> list[tuple]:
    """Texts of 4 to 90 words, their ends changed so that similarities lie on both sides of the threshold."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        words = prose(seed + g, rng.choice([4, 5, 6, 8, 9, 10, 12, 14, 20, 40, 66, 67, 70, 80, 90])).split()
        for _ in range(4):
            cut = rng.randint(0, max(len(words) // 5, 1))
            rows.append((len(rows), " ".join([*words[cut:], *(f"w{rng.randint(0, 2)}" for _ in range(rng.randint(0, 2)))])))
    return rows


def test_short_texts_lose_no_link(documents):
    # A line that half of all texts hold may not bring them together, nor hide the links that they have.
    line = "all rights reserved by the owner of this text"
    pairs = [(i, f"{t} {line}" if i % 2 else t) for i, t in short_copies(300, 150)]
    found = jaccard.near_duplicates(documents(pairs)).select("doc_id", "class_id", "n_links").collect()
    brute = jaccard_brute(pairs)
    assert sorted(map(tuple, found), key=repr) == brute
    assert sum(n for _, _, n in brute) > 100


def test_common_lines_alone_make_no_candidates(documents, spark):
    line = prose(900, 14)
    pairs = [(i, f"{prose(i + 1, 30)} {line}") for i in range(60)]
    sets = [np.unique(s) for s in jaccard.shingle_sets(*jaccard.texts(documents(pairs).toArrow().combine_chunks().column("text").chunk(0)))]
    rows = [(jaccard.fingerprint(s), len(s), s.astype(np.int64).tolist()) for s in sets]
    classes = spark.createDataFrame(rows, "print long, size long, few array<long>")
    assert jaccard._short_edges(classes, 0.8).count() == 0


def test_stop_is_shorter_where_trees_share_their_ranges():
    every = np.arange(jaccard.BINS)
    assert jaccard.stop_depth(every, 0.8, 0.9999) == jaccard.depth_for(0.8, 0.9999)
    half = np.tile(every[: jaccard.BINS // 2], 2)
    found = jaccard.stop_depth(half, 0.8, 0.9999)
    assert 1 < found < jaccard.depth_for(0.8, 0.9999) and 1 - (1 - 0.8**found) ** (jaccard.TREES // 2) >= 0.9999
    assert jaccard.stop_depth(np.zeros(jaccard.BINS, int), 0.8, 0.9999) == 1


@pytest.mark.parametrize("ranges", ["1", "7"])
def test_prefixes_are_shortened_step_by_step(spark, ranges):
    """Edges link exactly what shares a prefix of the shorter stop, also across ranges of the sort."""
    rng, depth = random.Random(3), 6
    minima = {p: np.array([rng.randrange(3) for _ in range(jaccard.BINS)], np.uint64) for p in range(-20, 20)}
    for p in range(1, 6):  # long common prefixes in one tree
        minima[p][:8] = minima[0][:8]
    stops = {p: rng.choice([6, 6, 6, 5, 4]) for p in minima}
    rows = [(p, stops[p], bytearray(jaccard._path(m).tobytes())) for p, m in minima.items()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        edges = jaccard._forest_edges(spark.createDataFrame(rows, "print long, stop int, paths binary"), depth)
        roots = {r["id"]: r["root"] for r in graph.components(edges).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    near = {p: {p} for p in minima}
    for t in range(jaccard.TREES):
        path = {p: tuple(m.reshape(jaccard.TREES, -1)[t]) for p, m in minima.items()}
        for p in minima:
            for q in minima:
                d = min(stops[p], stops[q])
                if path[p][:d] == path[q][:d]:
                    near[p].add(q)
    for p in minima:
        seen, todo = {p}, [p]
        while todo:
            for q in near[todo.pop()] - seen:
                seen.add(q)
                todo.append(q)
        assert roots.get(p, p) == min(seen)


def test_one_document_of_each_class_stays(documents):
    pairs = edge_texts() + near_copies(2, 5)
    frame = documents(pairs)
    kept = jaccard.keep_one(frame)
    assert kept.columns == frame.columns
    brute = jaccard_brute(pairs)
    classes = {c for i, c, n in brute if n}
    assert kept.count() == len(classes) + sum(1 for _, _, n in brute if not n)
    assert {r["doc_id"] for r in kept.collect()} >= classes


def test_prefix_depth_meets_the_recall():
    d = jaccard.depth_for(0.8, 0.9999)
    assert 1 - (1 - 0.8**d) ** jaccard.TREES >= 0.9999
    assert d < jaccard.DEPTH and 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TREES < 0.9999


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(50, 40), (41, 50), (60, 60), (7, 9), (7, 9)]
    found = {r["id"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(31)} | {50: 40, 40: 40, 41: 40}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def passages_brute(pairs):
    first: dict = {}
    for i, text in pairs:
        b = (text or "").encode()
        for k in range(len(b) - 49) if i is not None else ():
            first[b[k: k + 50]] = min(first.get(b[k: k + 50], i), i)
    out = []
    for i, text in pairs:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49) if i is not None else ():
            if first[b[k: k + 50]] < i:
                gone[k: k + 50] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        rises = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(b), int(gone.sum()), rises, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment", [1 << 20, 700])
def test_passages_equal_brute_force(documents, monkeypatch, segment):
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    pairs = edge_texts() + near_copies(2, 4)
    frame = documents(pairs).repartition(3)
    assert sorted(map(tuple, suffixes.without_repeats(frame).collect()), key=repr) == passages_brute(pairs)


def test_rows_of_one_id_in_several_blocks_lose_the_same_bytes(documents):
    passage = prose(70, 25)
    other = f"{prose(71, 20)} {passage} {prose(72, 20)}"
    pairs = [(1, f"{prose(73, 20)} {passage} {prose(74, 20)}"), (5, other), (5, other), (5, other), (9, f"{prose(75, 5)} {other}")]
    # A task's rows make its blocks: each row is in a block of its own.
    frame = documents(pairs[:1])
    for pair in pairs[1:]:
        frame = frame.union(documents([pair]))
    assert sorted(map(tuple, suffixes.without_repeats(frame).collect()), key=repr) == passages_brute(pairs)


def test_remaining_texts_keep_their_columns(documents):
    pairs = edge_texts()
    frame = documents(pairs)
    made = suffixes.remove_repeats(frame)
    assert made.schema.names == frame.schema.names
    rows = made.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in pairs)
    assert {r["text"] for r in rows if r["doc_id"] == 1} == {None}
    assert {r["text"] for r in rows if r["doc_id"] == 7} == {""}
    assert all(r["source"] == "s" and r["block"] == "b" for r in rows)


def test_deep_shallow_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (3000, 50)).astype(np.uint8)
    rows[::3, :44] = 97
    rows[1::3] = rows[7]
    order, new = suffixes.blind_tries(rows, *suffixes.shallow_sort(rows))
    groups = np.split(order, np.flatnonzero(new)[1:])
    assert sorted(order) == list(range(3000))
    assert len(groups) == len(np.unique(rows, axis=0))
    assert all(len(np.unique(rows[g], axis=0)) == 1 for g in groups)


ITEM = "If Alice has 12 apples and gives Bob 5 kg of them to her friends, how many apples does Alice have left after 3 days?"
OTHER = "If Carol has 40 apples and gives Dan 7 lb of them to her friends, how many apples does Carol have left after 9 days?"
MIXED = "If Carol has 40 apples and gives Carol 7 lb of them to her friends, how many apples does Eve have left after 7 days?"


def test_items_are_found_also_with_other_values(spark, documents):
    items = [(1, ITEM), (2, prose(50, 30)), (3, None), (4, ""), (5, "too short"), (6, ITEM)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pairs = edge_texts() + [
        (100, f"Well. {ITEM} So."), (101, f"{prose(1, 9)}. {OTHER} {prose(2, 9)}"), (102, MIXED), (103, prose(50, 30).upper()),
        (104, prose(50, 30)), (104, prose(50, 30)), (105, " ".join(prose(50, 30).split()[:9])),
    ]
    frame = documents(pairs)
    found = decontaminate.contaminated(frame, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["changed_slots"] > 0) for r in found) == [
        (100, 1, False), (101, 1, True), (103, 2, False), (104, 2, False), (104, 2, False)]
    clean = decontaminate.keep_clean(frame, bench)
    assert clean.columns == frame.columns
    assert clean.count() == len(pairs) - 5
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(frame, none).count() == 0
    assert decontaminate.keep_clean(frame.limit(0), bench).count() == 0


def found_items(spark, documents, items, pairs):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(documents(pairs), bench).collect()
    return sorted((r["doc_id"], r["item_id"]) for r in found)


def test_a_contradiction_leaves_the_consistent_run(spark, documents):
    words = prose(60, 60).split()
    words[9], words[50] = "5", "5"
    edited = [*words[:50], "6", *words[51:]]
    told = "there Alice has 3 red and 7 blue cups while Alice keeps the 3 red ones on her own shelf and gives the 7 others away"
    same = told.replace("3", "4").replace("7", "4").replace("Alice", "Carol")
    late = told.replace("Alice", "Carol").replace("the 7 others", "the 8 others")
    items = [(1, " ".join(words)), (2, told)]
    assert found_items(spark, documents, items, [(1, " ".join(edited)), (2, same), (3, late)]) == [(1, 1), (2, 2), (3, 2)]


def test_names_count_anywhere_and_in_any_case(spark, documents):
    short = "Tom has 5 red apples in a bag. Tom buys 7 more at noon."
    named = "The old king of France met his friend Louis and they gave Paris a bridge of stone"
    items = [(1, short), (2, "Tom sells very old green bottles"), (3, named)]
    pairs = [
        (1, short.replace("Tom", "Anna").replace("5", "9")), (2, "So it is. Anna sells very old green bottles"), (3, named.lower()),
        (4, named.replace(" ", "\n")), (5, named.upper()), (6, named.replace("Louis", "Karl").lower()),
    ]
    assert found_items(spark, documents, items, pairs) == [(1, 1), (2, 2), (3, 3), (4, 3), (5, 3), (6, 3)]


def test_short_and_number_heavy_items_are_found(spark, documents):
    shop = "A shop sold 1,000 red cups and 3.5 green ones to old men last year"
    items = [
        (1, "Solve 3x + 5 = 20"), (2, "What is 37 + 48 + 12?"), (3, "7 8 9 | 4 5 6 | 1 2 3 | 0 11 14 | 2 5"), (4, shop),
        (5, "12 kg 3 m 4 cm of rope cost him"), (6, "Quetzalcoatl?"),
    ]
    pairs = [(i, f"so {text} so") for i, text in items] + [
        (14, shop.replace("1,000", "12").replace("3.5", "7")), (15, "15 kg 8 m 9 cm of rope cost him"),
        (16, "Solve 3x + 5 = 21. What is 37 + 48 + 13? 7 8 9 | 4 5 6 | 1 2 9"),
    ]
    assert found_items(spark, documents, items, pairs) == [(i, i) for i in range(1, 7)] + [(14, 4), (15, 5)]


def topk_brute(rows, k):
    whole = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[n] = (i, [math.floor(256 * x) for x in v])
    asked = {}
    for i, v in whole.values():
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole.values() if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_huge_components_stay_exact(spark):
    rows = [(0, [7e305, 0.0]), (50, [1.0, 0.0]), (1, [0.0, 1.5]), (2, [-7e305, 0.0]), (3, [-1e300, 2.0]), (100, [0.0, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.exact_top_k(frame, frame.where("vec_id = 100"), 3)
    assert [(r["vec_id"], r["score"]) for r in found.orderBy("rank").collect()] == [(3, 512 * 64), (1, 384 * 64), (0, 0)]
    assert topk.whole(np.array([[7e305, -0.5]])).tolist() == [[int(7e305) * 256, -128]]


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE", 16)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.111, 1.0]) for _ in range(4)]) for i in range(180)]
    rows += [(1, [1.0] * 4), (50, [0.3] * 4), (None, [1.0] * 4), (200, None), (201, [None, 1.0, 1.0, 1.0]), (250, [float("nan")] * 4),
             (202, [float("inf")] * 4), (300, []), (301, []), (350, [1.0, 2.0]), (351, [3e9, 1e9, 1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(5)
    for block in (4096, 2):
        found = topk.exact_top_k(frame, frame.where("vec_id % 50 = 0"), 5, query_block=block)
        assert sorted(map(tuple, found.collect())) == topk_brute(rows, 5)
    assert topk.exact_top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_items_of_one_template_are_one_class(spark, documents):
    rng = random.Random(5)

    def question() -> str:
        name, (a, b, c) = rng.choice(["Alice", "Carol", "Emil"]), rng.sample(range(2, 999), 3)
        return f"If {name} has {a} apples and gives Bob {b} kg of them to her friends, how many apples does {name} have left after {c} days?"

    items = list(enumerate(sorted({question() for _ in range(300)})))
    equal = ITEM.replace("12", "7").replace(" 5 ", " 7 ")  # another class: two slots have one value
    items.append((len(items), equal))
    assert decontaminate.Reading(
        decontaminate.templates(*text.texts(pa.array([t for _, t in items])))[0], len(items), decontaminate.LITERAL
    ).lead.tolist() == [0] * (len(items) - 1) + [len(items) - 1]
    pairs = [(i, f"So {t} Well.") for i, t in items] + [(1000 + i, t.lower()) for i, t in items] + [(5000, OTHER.replace("Dan", "Carl"))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(documents(pairs).repartition(4), bench).collect()
    literal = {(r["doc_id"], r["item_id"]) for r in found if r["changed_slots"] == 0 and r["covered"] == r["item_tokens"]}
    assert literal == {(i, i) for i, _ in items} | {(1000 + i, i) for i, _ in items}
    assert 5000 in {r["doc_id"] for r in found}
    assert len(found) <= 4 * len(pairs)


@pytest.mark.parametrize("seed", range(3))
def test_classes_find_what_each_item_alone_finds(seed):
    rng = random.Random(seed)
    frame = prose(80, 24).split()

    def made() -> str:
        words = list(frame)
        for place in (3, 9, 10, 17, 22):
            words[place] = rng.choice(["5", "6", "two", "Ada", "Max"])
        return " ".join(words)

    items = sorted({made() for _ in range(40)})
    told = [made() for _ in range(30)]
    told += [x.lower() for x in told[:10]] + [" ".join(x.split()[: rng.randint(8, 24)]) for x in told]
    read = decontaminate.templates(*text.texts(pa.array(told)))

    def covered(found) -> dict[int, int]:
        longest: dict[int, int] = {}
        for t, _, n, *_ in found:
            longest[t] = max(longest.get(t, 0), n)
        return longest

    every, single = decontaminate.Items(list(range(len(items))), items), [decontaminate.Items([0], [x]) for x in items]
    for way in range(3):
        together = covered(every.readings[way].matches(read[way]))
        alone = covered(x for one in single for x in one.readings[way].matches(read[way]))
        if way < 2:
            assert together == alone
        else:  # a small letter name of any item of the class counts
            assert together.keys() == alone.keys() and all(together[t] >= alone[t] for t in alone)


def test_values_of_other_languages_are_slots(spark, documents):
    items = [
        (1, "Wenn Änne drei Körbe mit sieben Liter Saft füllt, wie viel Saft hat Änne nach neun Tagen noch im Haus?"),
        (2, "Si Élise achète trois pommes rouges et donne deux litres de jus à sa mère, combien reste-t-il après cinq jours à Élise?"),
        (3, "Si Íñigo compra tres libros viejos y regala dos kilos de pan a su madre, cuántos libros tiene Íñigo después de cinco días?"),
    ]
    told = [
        (1, items[0][1].replace("Änne", "Otto").replace("drei", "acht").replace("sieben", "12").replace("neun Tagen", "zwei Wochen")),
        (2, items[1][1].replace("Élise", "Marc").replace("trois", "huit").replace("deux", "6").replace("cinq jours", "sept heures")),
        (3, items[2][1].replace("Íñigo", "Óscar").replace("tres", "ocho").replace("dos", "9").replace("cinco días", "seis horas")),
        (4, items[0][1].replace("drei", "einige").replace("sieben", "manche").replace("neun", "wenigen")),
    ]
    assert found_items(spark, documents, items, told) == [(1, 1), (2, 2), (3, 3)]
