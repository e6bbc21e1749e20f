"""Text columns as bytes and hashed tokens, in numpy, straight from Arrow buffers.

A token's hash is a polynomial over its bytes, taken from running sums, then mixed to 64 bits. Equal
tokens have equal hashes; two different ones share a hash with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20  # bytes of text hashed at once; a longer token is hashed alone
BLOCK = 4 << 20  # bytes of texts handled together, or one longer text
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offset of each text (one more than texts); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``size`` bytes together."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n, modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    made = []
    for base in (_BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def _room(n: int) -> int:
    return max(SEGMENT, 1 << (max(n, 1) - 1).bit_length())


def release() -> None:
    """Give memory that is free but still held by the allocators back to the system.

    A Python worker outlives its task, and what it holds counts against the next one's.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable) -> Callable:
    """``work`` over batches or on one group, with memory given back after each result."""
    @wraps(work)
    def over_batches(batches, *more) -> Iterator:
        for made in work(batches, *more):
            yield made
            del made
            release()

    @wraps(work)
    def on_group(table, *more):
        try:
            return work(table, *more)
        finally:
            release()

    return over_batches if inspect.isgeneratorfunction(work) else on_group


@dataclass
class Classes:
    """What each byte is in a token: kind 0 separates, runs of one other kind make a token."""

    kind: np.ndarray
    fold: np.ndarray


def _fold_case() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold


def _kinds(separators: bytes | list[int], marks: bool = False) -> np.ndarray:
    kind = np.ones(256, np.uint8)
    kind[list(separators)] = 0
    if marks:
        plain = [b for b in range(33, 127) if not chr(b).isalnum()]
        kind[plain] = 2
    return kind


SPACES = [32, *range(9, 14)]
_NOT_WORD = [b for b in range(128) if not chr(b).isalnum()]
# Runs of anything but white space, A-Z lowered.
SPACED = Classes(_kinds(SPACES), _fold_case())
# Runs of letters, digits and all bytes beyond ASCII, A-Z lowered.
WORDS = Classes(_kinds(_NOT_WORD), _fold_case())
# Words as above and runs of punctuation; control characters separate.
MARKED = Classes(_kinds([*range(33), 127], marks=True), _fold_case())


@dataclass
class Tokens:
    """Tokens of some texts, in order: hash, index of the text, first byte and length in the buffer."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range [start, end) of ``data``; of long data, ranges in ascending order."""
    if len(data) > 2 * SEGMENT and len(start):
        # Segment by segment, so that the tables of powers stay small.
        cut = np.flatnonzero(np.diff(start // SEGMENT, prepend=-1))
        parts = []
        for a, b in zip(cut, np.append(cut[1:], len(start)), strict=True):
            low, high = int(start[a]), int(end[b - 1])
            parts.append(_hash_ranges(data[low:high], start[a:b] - low, end[a:b] - low))
        return np.concatenate(parts)
    return _hash_ranges(data, start, end)


def _hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    power, inverse = _powers(_room(n))
    running = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=running[1:])
    value = (running[end] - running[start]) * inverse[start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _cuts(kind: np.ndarray) -> Iterator[tuple[int, int]]:
    """Segments of about SEGMENT bytes that split no token."""
    first, n = 0, len(kind)
    while first < n:
        last = min(first + SEGMENT, n)
        while last < n:
            gaps = np.flatnonzero(kind[first:last][::-1] == 0)
            if len(gaps):
                last = last - int(gaps[0])
                break
            last = min(last + SEGMENT, n)
        yield first, last
        first = last


def tokens(data: np.ndarray, offsets: np.ndarray, classes: Classes = SPACED) -> Tokens:
    """Tokens of all texts. No token crosses from one text into the next."""
    kind = classes.kind[data]
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first, last in _cuts(kind):
        piece = kind[first:last]
        change = np.empty(last - first, bool)
        change[0] = True
        np.not_equal(piece[1:], piece[:-1], out=change[1:])
        inner = offsets[np.searchsorted(offsets, first): np.searchsorted(offsets, last)] - first
        change[inner] = True
        at = np.flatnonzero(change)
        ends = np.append(at[1:], last - first)
        kept = piece[at] != 0
        at, ends = at[kept], ends[kept]
        if len(at):
            parts.append((hash_ranges(classes.fold[data[first:last]], at, ends), at + first, ends - at))
    if not parts:
        nothing = np.zeros(0, np.int64)
        return Tokens(np.zeros(0, np.uint64), nothing, nothing, nothing)
    hashes, start, length = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Tokens(hashes, np.searchsorted(offsets, start, "right") - 1, start, length)


def token_bounds(found: Tokens, rows: int) -> np.ndarray:
    """Index of each text's first token, and the number of tokens at the end."""
    return np.searchsorted(found.text, np.arange(rows + 1))


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` tokens within one text, and the index of its first token."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    for i in range(size):
        value = (value + hashes[i: i + n]) * np.uint64(_BASE)
        value ^= value >> np.uint64(29)
    inside = np.flatnonzero(text[:n] == text[size - 1:])
    return mix(value[inside]), inside
