"""Benchmark decontamination by template canonicalisation and windows.

Texts become templates: numbers (digits, also with separators, or number words), units behind a number and names turn into typed
placeholders, words of four languages among them; all else is the lower-cased word. Each text is read three times: with capitalised words
inside a sentence as names, a run of them as one, with each capitalised word as a name, wherever it
stands, and as plain lower-cased words, so that a literal copy never depends on typing. Windows of
``WINDOW`` tokens, in templates those with at least ``LITERAL`` plain words, are hash-joined with those of the
benchmark. Stretches of matching windows are carried on while tokens match; there a name also matches a
word that is not written as one. Along every diagonal of matching windows the slots must agree: one value of the item
always stands for one value of the document. So a question with other numbers and names is found, and a
mere coincidence of pattern is not. An item is found in a document where a consistent run covers ``RUN``
tokens, or the whole of a shorter item. Where slots of a stretch contradict each other, its longest
consistent runs are looked at; beside a contradiction the pattern alone says little, so such a run has
to be borne out: as many slots keep or repeat a value as values changed, or it has ``LONG`` tokens.

Items that differ only in the values of their slots, with equal values in the same places, are one class: a
text holds all or none of their common pattern. Windows, stretches and slots are searched once for a class, and
its nearest item, the one with the fewest slots that differ, gives the row. So many items of one template
against many texts of it make a row for each place in a text, not one for each pair. Among plain words a name
matches that of any item of the class, so a run there may be longer than with its nearest item alone.

The benchmark is the stated query set: it is read in blocks of at most ``BLOCK_BYTES`` of text, each
broadcast in turn. Documents stay where they are read and are never shuffled.

Defined results
    Null or empty texts, and items without any word, match nothing. Items of fewer than ``LEAST`` tokens,
    and others without a window of ``LITERAL`` plain words, are found word for word only, the short ones
    wherever their words stand in a row, even a single one. Items of equal text count as one, under the smallest id.
    Of the items of a class equally near to a place the smallest id counts.
    Of the three readings the one that covers most of an item gives its row. A run of several names is one
    token only inside a sentence and with capitals. Repeated documents are answered each. Null ids are kept as they are. No rows: no rows. Further
    columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.text import WORDS, Tokens, blocks, hash_ranges, mix, texts, tokens, windows

WINDOW = 8  # and shorter ones, down to the whole of the shortest item, in plain words
LITERAL = 4
LEAST = 5
RUN = 13
LONG = 2 * RUN
BLOCK_BYTES = 16 << 20
WORD, NUMBER, NAME, UNIT = range(4)
# Words of English, German, French and Spanish; without the Spanish 11, which is another word in English.
NUMBERS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
    "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn "
    "achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen milliarde "
    "milliarden zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente "
    "quarante cinquante soixante mille millions milliard milliards cero dos tres cuatro cinco seis siete ocho nueve diez "
    "doce trece catorce quince veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil millón "
    "millones"
).split()
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g gram grams kg kilogram kilograms oz ounce "
    "ounces lb lbs pound pounds ton tons ml l liter liters litre litres gallon gallons ms s sec second seconds min minute "
    "minutes h hr hour hours day days week weeks month months year years c f k kph mph hz khz mhz ghz w kw v a j kj "
    "dollar dollars euro euros cent cents usd eur percent degree degrees "
    "tag tage tagen stunde stunden minuten sekunde sekunden woche wochen monat monate monaten jahr jahre jahren meter "
    "kilometer zentimeter gramm kilogramm kilo grad prozent jour jours heure heures seconde secondes semaine semaines mois "
    "an ans année années mètre mètres kilomètre kilomètres gramme grammes kilos litres degré degrés centimes día días hora "
    "horas minuto minutos segundo segundos semana semanas mes meses año años metro metros kilómetro kilómetros gramo "
    "gramos litro litros grado grados céntimos"
).split()
_BREAKS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])
_SEPARATES = np.isin(np.arange(256), [ord(c) for c in ".,"])
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))


def _hashes(words: list[str]) -> np.ndarray:
    written = [w.encode() for w in words]
    size = [len(w) for w in written]
    ends = np.cumsum(size)
    return np.sort(hash_ranges(np.frombuffer(b"".join(written), np.uint8), ends - size, ends))


def _capitals(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a capital letter: A-Z, and those of Latin-1, which have two bytes."""
    latin = np.zeros(len(data), bool)
    latin[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return latin | _UPPER[data]


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


_KINDS = _hashes(["<number>", "<name>", "<unit>"])
_NUMBER_WORDS, _UNIT_WORDS = _hashes(NUMBERS), _hashes(UNITS)


@dataclass
class Templates:
    """Tokens of some texts, read in one way: hash, index of the text, kind, and hash of what was written."""

    hash: np.ndarray
    text: np.ndarray
    kind: np.ndarray
    value: np.ndarray


def templates(data: np.ndarray, offsets: np.ndarray) -> list[Templates]:
    """Templates with names inside sentences, templates with names anywhere, and plain words."""
    found = _numbers(data, tokens(data, offsets, WORDS))
    if not len(found.hash):
        return [Templates(found.hash, found.text, np.zeros(0, np.uint8), found.hash)] * 3
    end = found.start + found.length
    first = np.append(True, found.text[1:] != found.text[:-1])
    number = _DIGIT[data[found.start]] | _within(found.hash, _NUMBER_WORDS)
    unit = _within(found.hash, _UNIT_WORDS) & ~first & np.append(False, number[:-1])
    # A name: a capital, then none. Inside a sentence: no end of one between it and the word before.
    before = np.append(0, end[:-1])
    capital = _capitals(data)
    capitals = np.append(0, np.cumsum(capital))
    letter = 1 + (data[found.start] == 0xC3)
    titled = capital[found.start] & (capitals[end] - capitals[found.start] == 1) & (found.length > letter)
    breaks = np.append(0, np.cumsum(_BREAKS[data]))
    inside = ~first & (breaks[found.start] == breaks[before])
    made = []
    # Where any capital makes a name, runs stay apart: the first word of a sentence may be no part of the name.
    for name, joined in ((titled & inside, ~first), (titled, np.zeros(len(first), bool))):
        kind = np.select([number, unit & ~number, name], [NUMBER, UNIT, NAME], WORD).astype(np.uint8)
        again = np.append(False, (kind[1:] == NAME) & (kind[:-1] == NAME)) & joined
        made.append(_merged(found.hash, found.text, kind, again))
    # Plain words keep their kinds, for what lies beside a literal stretch.
    return [*made, Templates(made[1].value, made[1].text, made[1].kind, made[1].value)]


def _joined(value: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of runs of tokens, the tokens marked ``again`` each belonging to the one before; where runs begin."""
    at = np.flatnonzero(~again)
    step = np.arange(len(value)) - np.repeat(at, np.diff(np.append(at, len(value))))
    return np.add.reduceat(value * (2 * step + 1).astype(np.uint64), at), at


def _numbers(data: np.ndarray, found: Tokens) -> Tokens:
    """Tokens in which a number with separators, as 1,000 or 3.5, is one."""
    if not len(found.hash):
        return found
    end = found.start + found.length
    digit = _DIGIT[data[found.start]]
    beside = (found.text[1:] == found.text[:-1]) & (found.start[1:] == end[:-1] + 1) & digit[1:] & digit[:-1]
    again = np.append(False, beside & _SEPARATES[data[found.start[1:] - 1]] & _DIGIT[data[end[:-1] - 1]])
    if not again.any():
        return found
    value, at = _joined(found.hash, again)
    last = np.append(at[1:], len(again)) - 1
    return Tokens(value, found.text[at], found.start[at], end[last] - found.start[at])


def _merged(value: np.ndarray, text: np.ndarray, kind: np.ndarray, again: np.ndarray) -> Templates:
    """Templates in which the tokens marked ``again`` are one with those before them."""
    if again.any():
        value, at = _joined(value, again)
        kind, text = kind[at], text[at]
    shown = np.where(kind == WORD, value, _KINDS[np.maximum(kind, 1) - 1])
    return Templates(shown, text, kind, value)


def keyed(found: Templates, size: int, literal: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows with enough plain words, and the index of their first tokens."""
    value, at = windows(found.hash, found.text, size)
    plain = np.append(0, np.cumsum(found.kind == WORD))
    enough = plain[at + size] - plain[at] >= literal
    return value[enough], at[enough]


class Reading:
    """Windows of a block of benchmark items, read in one way, in order of their hashes."""

    def __init__(self, found: Templates, rows: int, literal: int) -> None:
        self.found, self.literal = found, literal
        self.bounds = np.searchsorted(found.text, np.arange(rows + 1))
        size = np.diff(self.bounds)
        self._classify(rows)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in range(LEAST if literal else 1, WINDOW + 1):
            value, at = keyed(found, n, literal)
            wanted = size[found.text[at]] >= WINDOW if n == WINDOW else size[found.text[at]] == n
            value, at = value[wanted], at[wanted]
            if n == WINDOW or literal:  # once for a class, where its first item has them
                item = found.text[at]
                at = self.bounds[self.lead[item]] + at - self.bounds[item]
            if len(value):
                order = np.lexsort((at, value))
                value, at = value[order], at[order]
                fresh = np.append(True, (value[1:] != value[:-1]) | (at[1:] != at[:-1]))
                value, at = value[fresh], at[fresh]
                near = np.zeros(1 << 22, bool)
                near[(value & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
                self.by_size[n] = (value, at, near)

    def _classify(self, rows: int) -> None:
        """The first item of each item's class, and the items of each class that has several."""
        found = self.found
        shown = np.where(found.kind == WORD, found.value, _KINDS[np.maximum(found.kind, 1) - 1])
        # A slot is told by the place of the first slot of its item with the same value.
        slots = np.flatnonzero(found.kind != WORD)
        slots = slots[np.lexsort((slots, found.value[slots], found.kind[slots], found.text[slots]))]
        new = np.ones(len(slots), bool)
        if len(slots):
            new[1:] = np.any([x[slots[1:]] != x[slots[:-1]] for x in (found.value, found.kind, found.text)], axis=0)
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        place = np.zeros(len(shown), np.int64)
        place[slots] = first - self.bounds[found.text[slots]] + 1
        classes: dict[bytes, list[int]] = {}
        for i, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:], strict=True)):
            key = hashlib.blake2b(shown[a:b].tobytes() + place[a:b].tobytes(), digest_size=16).digest()
            classes.setdefault(key, []).append(i)
        self.lead = np.zeros(rows, np.int64)
        self.members: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # and what they have at each place
        for items in classes.values():
            self.lead[items] = items[0]
            if len(items) > 1:
                places = np.arange(self.bounds[items[0] + 1] - self.bounds[items[0]])
                self.members[items[0]] = np.array(items), found.value[self.bounds[items] + places[:, None]]
        # Names of the others of a class, by place: a copy in small letters may hold any of them.
        names = np.flatnonzero((found.kind == NAME) & (self.lead[found.text] != found.text)) if rows else slots
        item = found.text[names]
        self.names = np.unique(_placed(found.value[names], self.bounds[self.lead[item]] + names - self.bounds[item]))

    def matches(self, found: Templates) -> Iterator[tuple[int, int, int, int, int]]:
        """Text, item, how many tokens are covered, how many the item has, and how many slots differ."""
        pairs = []
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for size, (value, at, near) in self.by_size.items():
            mine, place = keyed(found, size, self.literal)
            hit = near[(mine & np.uint64((1 << 22) - 1)).astype(np.int64)]
            mine, place = mine[hit], place[hit]
            low, high = np.searchsorted(value, mine, "left"), np.searchsorted(value, mine, "right")
            n = high - low
            which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            if size < WINDOW and not self.literal:  # a whole item, word for word
                both = np.unique(np.stack([np.repeat(found.text[place], n), self.found.text[at[which]]], 1), axis=0)
                best.update(((t, i), (size, 0)) for t, i in both.tolist())
                continue
            pairs.append((np.repeat(place, n), at[which], np.full(n.sum(), size)))
        if pairs:
            place, at, size = (np.concatenate(x) for x in zip(*pairs, strict=True))
            if len(at):
                self._stretches(found, place, at, size, best)
        for (t, i), (covered, differing) in best.items():
            yield t, i, covered, int(self.bounds[i + 1] - self.bounds[i]), differing

    def _stretches(self, found: Templates, place: np.ndarray, at: np.ndarray, size: np.ndarray, best: dict) -> None:
        """Add the longest run and its differing slots for each text and item with matching windows."""
        item = self.found.text[at]
        text = found.text[place]
        shift = place - at
        order = np.lexsort((at, shift, item, text))
        place, at, size, item, text, shift = (x[order] for x in (place, at, size, item, text, shift))
        # A new stretch wherever the next window does not overlap the one before on its diagonal.
        new = np.ones(len(at), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (at[1:] > at[:-1] + size[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(at)) - 1
        ends = np.searchsorted(found.text, text[start]), np.searchsorted(found.text, text[start], "right")
        for a, b, low, high in zip(start, stop, *ends, strict=True):
            first, last = self.bounds[item[a]], self.bounds[item[a] + 1]
            head = self._reach(found, place[a] - 1, at[a] - 1, min(place[a] - low, at[a] - first), at[a] - first, -1)
            tail = at[b] + size[b]
            behind = self._reach(found, tail + shift[a], tail, min(high - tail - shift[a], last - tail), last - tail, 1)
            covered = tail + behind - at[a] + head
            whole = last - first
            if covered < min(RUN, whole):
                continue
            # Also without what lies beside it, if that contradicts it.
            for before, n in ((head, covered), (0, tail - at[a])):
                runs = self._runs(found, int(place[a] - before), int(at[a] - before), int(n), int(min(RUN, whole)), int(item[a]))
                for i, *run in runs:
                    key = (int(text[a]), i)
                    best[key] = max(best.get(key, (0, 0)), tuple(run))
                if any(length == n for _, length, _ in runs):
                    break

    def _reach(self, found: Templates, place: int, at: int, n: int, left: int, step: int) -> int:
        """How many of ``n`` tokens from a place on, forwards or backwards, match; the item has ``left`` more."""
        if n <= 0:
            return 0
        mine = slice(place, place + n) if step > 0 else slice(place - n + 1, place + 1)
        theirs = slice(at, at + n) if step > 0 else slice(at - n + 1, at + 1)
        kind = found.kind[mine]
        same = (found.hash[mine] == self.found.hash[theirs]) | ((kind == self.found.kind[theirs]) & (kind != WORD))
        if not self.literal and len(self.names):
            same |= _within(_placed(found.hash[mine], np.arange(theirs.start, theirs.stop)), self.names)
        same = same[::step]
        named = _named(kind, self.found.kind[theirs])[::step] & ~same
        named &= ~np.append(False, named[:-1])
        reach = int(np.argmin(np.append(same | named, False)))
        # A name matched with another word counts only between matches, or where the item ends.
        return reach - 1 if reach and not same[reach - 1] and reach < left else reach

    def _runs(self, found: Templates, place: int, at: int, n: int, least: int, lead: int) -> list[tuple[int, int, int]]:
        """Item, length and differing slots of the longest consistent run of a stretch, for the items nearest to a run."""
        mine, kind = found.kind[place: place + n], self.found.kind[at: at + n]
        kind = np.where(_named(mine, kind), NAME, kind)
        slots = np.flatnonzero(kind != WORD)
        keys = list(zip(kind[slots].tolist(), self.found.value[at + slots].tolist(), strict=True))
        written = found.value[place + slots]
        values = written.tolist()
        # Two pointers: a slot that contradicts an earlier one starts the next run behind that one.
        runs, first, begin, seen = [], 0, 0, {}
        for i, (key, value) in enumerate(zip(keys, values, strict=True)):
            before = seen.get(key)
            if before is not None and before >= begin and values[before] != value:
                runs.append((first, int(slots[i]), begin, i))
                first, begin = int(slots[before]) + 1, before + 1
            seen[key] = i
        runs.append((first, n, begin, len(keys)))
        begins, ends = self.bounds[lead], self.bounds[lead + 1]
        members, held = self.members.get(lead) or (np.array([lead]), self.found.value[begins:ends, None])
        held = held[at - begins + slots]
        best: dict[int, tuple[int, int]] = {}
        for first, last, begin, end in runs:
            if last - first < least:
                continue
            differs = held[begin:end] != written[begin:end, None]
            differing = np.count_nonzero(differs, axis=0)
            if len(runs) > 1 and last - first < LONG:
                leads = [i for i in range(end - begin) if keys[begin + i] not in keys[begin: begin + i]]
                changed = np.count_nonzero(differs[leads], axis=0)
                differing[end - begin - changed < changed] = n + 1  # not borne out
            nearest = int(np.argmin(differing))
            if differing[nearest] <= n:
                run = last - first, int(differing[nearest])
                best[int(members[nearest])] = max(best.get(int(members[nearest]), (0, 0)), run)
        return [(i, *run) for i, run in best.items()]


def _placed(value: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hashes of values at their places."""
    return mix(value ^ mix(place))


def _named(kind: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Where one of two tokens is a name and the other a word."""
    return ((kind == NAME) & (other == WORD)) | ((kind == WORD) & (other == NAME))


class Items:
    """A block of benchmark items in all their readings."""

    def __init__(self, ids: list, item_texts: list[str]) -> None:
        self.ids = ids
        read = templates(*texts(pa.array(item_texts, pa.string())))
        self.readings = [Reading(x, len(ids), n) for x, n in zip(read, (LITERAL, LITERAL, 0), strict=True)]

    def matches(self, read: list[Templates]) -> Iterator[tuple[int, int, int, int, int]]:
        """As of the reading that covers most of the item, the first of equal ones."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for reading, found in zip(self.readings, read, strict=True):
            for t, i, covered, whole, differing in reading.matches(found):
                before = best.get((t, i))
                if before is None or covered * before[1] > before[0] * whole:
                    best[t, i] = covered, whole, differing
        for (t, i), (covered, whole, differing) in best.items():
            yield t, i, covered, whole, differing


def item_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the items, in blocks of bounded size."""
    items = (
        benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text <> ''")
        .groupBy("text").agg(F.min("item_id").alias("item_id"))
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    for block in range(count):
        mine = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == block).collect()
        mine.sort(key=lambda r: (r["item_id"] is None, r["item_id"]))  # the first item of a class is its smallest
        yield [r["item_id"] for r in mine], [r["text"] for r in mine]


def contaminated(
    documents: DataFrame, benchmark: DataFrame,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, covered, item_tokens, changed_slots): a row for each item found in a document."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = [rows.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, covered int, item_tokens int, changed_slots int"
    made = None
    for ids, item_texts in item_blocks(benchmark, item_id, item_text):
        held = documents.sparkSession.sparkContext.broadcast(Items(ids, item_texts))
        part = rows.mapInArrow(_finder(held), schema)
        made = part if made is None else made.unionByName(part)
    return made


def _found(batch: pa.RecordBatch, column: str, items: Items) -> list[tuple[int, int, int, int, int]]:
    data, offsets = texts(batch.column(column))
    out = []
    for first, last in blocks(offsets):
        read = templates(data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
        out += [(first + t, *found) for t, *found in items.matches(read)]
    return out


def _finder(held):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        for batch in batches:
            out = _found(batch, "text", items)
            ids = pa.array([items.ids[i] for _, i, *_ in out])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array([t for t, *_ in out], pa.int64())),
                    ids if len(out) else pa.array([], pa.int64()),
                    pa.array([n for _, _, n, *_ in out], pa.int32()),
                    pa.array([n for *_, n, _ in out], pa.int32()),
                    pa.array([k for *_, k in out], pa.int32()),
                ],
                ["doc_id", "item_id", "covered", "item_tokens", "changed_slots"],
            )

    return find


def keep_clean(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``documents``, all their columns, in which no item is found."""
    kept = documents
    for ids, item_texts in item_blocks(benchmark, item_id, item_text):
        held = documents.sparkSession.sparkContext.broadcast(Items(ids, item_texts))
        kept = kept.mapInArrow(_keeper(held, text), documents.schema)
    return kept


def _keeper(held, text: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(len(batch), bool)
            clean[[t for t, *_ in _found(batch, text, held.value)]] = False
            yield batch.filter(pa.array(clean))

    return keep
