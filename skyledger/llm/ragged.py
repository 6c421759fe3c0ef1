"""Numpy kernels over a batch of texts held as one array of code points.

A batch is cut into chunks of bounded size, each chunk is one flat array, and
words or pre-tokens are (start, end) spans in it. Equal spans are found by a
64-bit hash, so that work per distinct span is done once per chunk.
"""

from __future__ import annotations

import ctypes
import unicodedata
from collections.abc import Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa
from tokenizers import Regex, normalizers, pre_tokenizers

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

# fixed values: code points with the Unicode property White_Space
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# fixed values: white space as the contracts of the words and shingles name it
ASCII_SPACE = [0x20, *range(0x09, 0x0E)]

CHUNK = 1_500_000
# symbols that are hashed at once
STRETCH = 1 << 19
_C = ctypes.CDLL(None)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _newer() -> list[int]:
    """Code points that Python's Unicode tables have no character for; those of the tokenizer library may, as they are of another version."""
    return [p for p in range(0x40000) if unicodedata.category(chr(p)) == "Cn"]


@cache
def classes() -> np.ndarray:
    """Class of every code point as the tokenizer library sees it: letter, number, white space or other."""
    kind = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))[0]
        if category in "LN":
            kind[point] = LETTER if category == "L" else NUMBER
    newer = np.array(_newer())
    text = "".join(map(chr, newer))
    for pattern, name in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for _, (start, end) in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text):
            kind[newer[start:end]] = name
    kind[WHITE_SPACE] = SPACE
    return kind


@cache
def lower_table() -> np.ndarray:
    """Lower case of every code point whose lower case is one code point, as the tokenizer library sees it."""
    table = np.arange(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        low = chr(point).lower()
        if len(low) == 1:
            table[point] = ord(low)
    newer = _newer()
    for point, low in zip(newer, normalizers.Lowercase().normalize_str("\n".join(map(chr, newer))).split("\n")):
        if len(low) == 1:
            table[point] = ord(low)
    return table


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, as many as a stretch has."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.empty(STRETCH, np.uint64), np.empty(STRETCH, np.uint64)
    for out, base in ((up, _BASE), (down, inverse)):
        out[0], done, step = 1, 1, base
        while done < STRETCH:
            more = min(done, STRETCH - done)
            out[done : done + more] = out[:more] * np.uint64(step)
            done, step = done + more, step * step & _MASK
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` characters together (one text at least)."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the offsets of the texts in it."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def doc_starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """True at the first character of every text, and at the end of the last one."""
    flags = np.zeros(size + 1, bool)
    flags[offsets] = True
    return flags


def words(space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the maximal runs without space, none of which crosses two texts."""
    size = len(space)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = doc_starts(offsets, size)
    solid = ~space
    before = np.zeros(size, bool)
    before[1:] = solid[:-1]
    after = np.zeros(size, bool)
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends


def span_hash(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span, equal for equal contents wherever they stand; spans follow one another without overlap.

    Texts of any length are gone over in stretches, whose sums take bounded
    memory. A span longer than that is the hash of the hashes of its stretches.
    """
    if len(symbols) <= STRETCH:
        return _stretch_hash(symbols, starts, ends)
    value = np.zeros(len(starts), np.uint64)
    long_ = np.append(np.flatnonzero(ends - starts > STRETCH), len(starts))
    at = 0
    for stop in long_:
        while at < stop:
            begin = starts[at]
            more = min(int(np.searchsorted(ends, begin + STRETCH, side="right")), int(stop))
            value[at:more] = _stretch_hash(symbols[begin : begin + STRETCH], starts[at:more] - begin, ends[at:more] - begin)
            at = more
        if stop < len(starts):
            cuts = np.arange(starts[stop], ends[stop], STRETCH)
            inner = np.concatenate([_stretch_hash(part, np.zeros(1, np.int64), np.array([len(part)])) for part in (symbols[c : min(c + STRETCH, ends[stop])] for c in cuts)])
            value[stop] = span_hash(inner, np.zeros(1, np.int64), np.array([len(inner)]))[0]
            at = stop + 1
    return value


def _stretch_hash(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = len(symbols)
    up, down = _powers()
    held = np.zeros(size + 1, np.uint64)
    np.cumsum(mix(symbols.astype(np.uint64) + np.uint64(0x51ED270B)) * up[:size], out=held[1:])
    value = (held[ends] - held[starts]) * down[np.minimum(starts, STRETCH - 1)]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def release() -> None:
    """Give memory that is no longer used back to the system: workers live on, for the tasks of other stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def tidy(run):
    """A task's generator that releases memory when it ends."""

    @wraps(run)
    def wrapped(*arguments):
        try:
            yield from run(*arguments)
        finally:
            release()

    return wrapped


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the spans, span after span."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def per_text(values: np.ndarray, owner_starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive values; ``owner_starts`` has the first index of each owner and the end."""
    held = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=held[1:])
    return held[owner_starts[1:]] - held[owner_starts[:-1]]
