"""Byte pair merging of whole batches of pre-tokens in numpy, rank by rank.

Pre-tokens are cut from the texts with array operations that follow the split
patterns of the vocabulary files, distinct ones are merged together: in every
round each sequence replaces all occurrences of its own lowest-ranked pair.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import numpy as np

from skyledger.llm import ragged

NONE = np.int64(1 << 40)

# fixed values: letters that may follow an apostrophe in a contraction
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in the vocabulary files."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class Merger:
    """Merge table of a vocabulary file and the merging itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.lowered = "Lowercase" in json.dumps(spec["normalizer"])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of every sequence of bytes (none of them empty)."""
        if not len(lengths):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[data[ends - 1]]
        starts = ends - lengths
        owners = np.arange(len(lengths))
        rank = np.full(len(symbols), NONE)
        if len(symbols) > 1:
            rank[:-1] = self._rank(symbols[:-1], symbols[1:])
        rank[ends - 1] = NONE
        counts = np.zeros(len(lengths), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(owners):
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            live = best < NONE
            if not live.all():
                over = ~live
                counts[owners[over]] = sizes[over]
                done.append((owners[over], symbols[np.repeat(over, sizes)]))
                inside = np.repeat(live, sizes)
                symbols, rank, owners, best, sizes = symbols[inside], rank[inside], owners[live], best[live], sizes[live]
                if not len(owners):
                    break
                starts = np.cumsum(sizes) - sizes
            hit = rank == np.repeat(best, sizes)
            # of overlapping occurrences (the same symbol again and again) every second one counts
            chained = np.flatnonzero(hit[1:] & hit[:-1]) + 1
            if len(chained):
                place = np.flatnonzero(hit)
                breaks = np.append(True, np.diff(place) > 1)
                run = np.maximum.accumulate(np.where(breaks, np.arange(len(place)), 0))
                hit[place[(np.arange(len(place)) - run) % 2 == 1]] = False
            place = np.flatnonzero(hit)
            symbols[place] = self.made[rank[place]]
            keep = np.ones(len(symbols), bool)
            keep[place + 1] = False
            last = np.zeros(len(symbols), bool)
            last[np.append(starts[1:], len(symbols)) - 1] = True
            last[place] = last[place + 1]
            touched = np.zeros(len(symbols), bool)
            touched[place] = True
            before = place - 1
            before = np.where((before >= 0) & ~keep[before], before - 1, before)
            touched[before[before >= 0]] = True
            new = np.cumsum(keep) - 1
            symbols, rank, last, touched = symbols[keep], rank[keep], last[keep], touched[keep]
            sizes = sizes - np.bincount(np.searchsorted(starts, place, side="right") - 1, minlength=len(starts))
            starts = new[starts]
            at = np.flatnonzero(touched)
            open_ = at[~last[at]]
            rank[at] = NONE
            rank[open_] = self._rank(symbols[open_], symbols[open_ + 1])
        if not done:
            return np.zeros(0, np.int64), counts
        order = np.concatenate([o for o, _ in done])
        flat = np.concatenate([s for _, s in done])
        sizes = counts[order]
        begin = np.cumsum(sizes) - sizes
        back = np.argsort(order)
        return flat[ragged.gather(begin[back], sizes[back])], counts


@cache
def merger(path: str) -> Merger:
    return Merger(path)


def spans(text: np.ndarray, offsets: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the pre-tokens.

    ``spaced``: one space belongs to the token behind it and other white space
    forms tokens; else white space is dropped and every number character
    stands alone.
    """
    size = len(text)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = ragged.classes()[text]
    first = ragged.doc_starts(offsets, size)
    begin = first.copy()
    begin[1:size] |= kind[1:] != kind[:-1]
    begin[size] = True
    if spaced:
        follow = np.flatnonzero(begin[1:size] & (kind[1:] != ragged.SPACE) & (kind[:-1] == ragged.SPACE) & ~first[1:size]) + 1
        begin[follow - 1] = True
        begin[follow[text[follow - 1] == 0x20]] = False
    else:
        begin[:size] |= kind == ragged.NUMBER
    quotes = np.flatnonzero((text == 0x27) & begin[:size])
    quotes = quotes[quotes + 1 < size]
    quotes = quotes[(kind[quotes + 1] == ragged.LETTER) & ~first[quotes + 1]]
    ends = np.zeros(len(quotes), np.int64)
    for letters in CONTRACTIONS:
        fits = quotes + len(letters) < size
        for k, letter in enumerate(letters, 1):
            at = np.minimum(quotes + k, size - 1)
            fits &= (text[at] == ord(letter)) & ~first[at]
        ends[fits] = quotes[fits] + len(letters) + 1
    begin[quotes[ends > 0] + 1] = False
    begin[ends[ends > 0]] = True
    starts = np.flatnonzero(begin)
    starts, ends = starts[:-1], starts[1:]
    if not spaced:
        solid = kind[starts] != ragged.SPACE
        starts, ends = starts[solid], ends[solid]
    return starts, ends


def normal(text: str) -> str:
    """Composed text, ready for lower-casing by code point."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if any(len(c.lower()) > 1 for c in set(text)):
            text = "".join(c.lower() for c in text)
    return text


def pieces(texts: list[str], special: dict[str, int]) -> tuple[list[str], list[int], list[int]]:
    """Texts cut at the special strings: the parts, the text each is of, and the special id that follows it (-1: none)."""
    parts, owners, follow = [], [], []
    # of special strings that begin at one place the longest counts
    any_of = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
    for i, text in enumerate(texts):
        start = 0
        for hit in any_of.finditer(text):
            parts.append(text[start : hit.start()])
            owners.append(i)
            follow.append(special[hit.group()])
            start = hit.end()
        parts.append(text[start:])
        owners.append(i)
        follow.append(-1)
    return parts, owners, follow


def encode(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and the number of ids of each text."""
    table = merger(path)
    parts, owners, follow = pieces(texts, table.special)
    at, owner_starts = _cut(parts, path)
    lengths = known(path).sizes[at]
    ids = known(path).ids()[ragged.gather(known(path).begin[at], lengths)]
    part_lengths = ragged.per_text(lengths, owner_starts)
    marks = np.array(follow)
    if (marks >= 0).any():
        at = np.cumsum(part_lengths)[marks >= 0]
        ids = np.insert(ids, at, marks[marks >= 0])
        part_lengths = part_lengths + (marks >= 0)
    return ids, np.bincount(owners, part_lengths, len(texts)).astype(np.int64)


def count(texts: list[str], path: str) -> np.ndarray:
    """Number of ids of each text."""
    table = merger(path)
    parts, owners, follow = pieces(texts, table.special)
    at, owner_starts = _cut(parts, path)
    part_lengths = ragged.per_text(known(path).sizes[at], owner_starts) + (np.array(follow) >= 0)
    return np.bincount(owners, part_lengths, len(texts)).astype(np.int64)


class Known:
    """Ids of the distinct pre-tokens a worker has met, found by hash; dropped as a whole when it is full."""

    def __init__(self, table: Merger, most: int = 1_000_000):
        self.table, self.most = table, most
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begin, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat: list[np.ndarray] = []
        self.held = 0

    def places(self, hashes: np.ndarray, first: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the given distinct pre-tokens stand in ``begin`` and ``sizes``; unknown ones are merged and added."""
        if len(self.hashes) + len(hashes) > self.most:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        near = np.minimum(at, max(len(self.hashes) - 1, 0))
        new = self.hashes[near] != hashes if len(self.hashes) else np.ones(len(hashes), bool)
        if new.any():
            begin, lengths = starts[first[new]], ends[first[new]] - starts[first[new]]
            used = text[ragged.gather(begin, lengths)]
            data = np.frombuffer(used.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
            width = 1 + (used >= 0x80).astype(np.int64) + (used >= 0x800) + (used >= 0x10000)
            flat, sizes = self.table.merge(data, ragged.per_text(width, np.append(0, np.cumsum(lengths))))
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.begin = np.insert(self.begin, at[new], self.held + np.cumsum(sizes) - sizes)
            self.sizes = np.insert(self.sizes, at[new], sizes)
            self.flat.append(flat.astype(np.uint32))
            self.held += len(flat)
            at = np.searchsorted(self.hashes, hashes)
        return at

    def ids(self) -> np.ndarray:
        self.flat = [np.concatenate(self.flat)] if self.flat else [np.zeros(0, np.uint32)]
        return self.flat[0]


@cache
def known(path: str) -> Known:
    return Known(merger(path))


def _cut(parts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The places of all pre-tokens of the parts in ``known(path)``, and where parts begin among them."""
    lowered = merger(path).lowered
    if lowered:
        parts = [normal(p) for p in parts]
    text, offsets = ragged.points(parts)
    if lowered:
        text = ragged.lower_table()[text]
    starts, ends = spans(text, offsets, spaced=not lowered)
    hashes, first, inverse = np.unique(ragged.span_hash(text, starts, ends), return_index=True, return_inverse=True)
    at = known(path).places(hashes, first, text, starts, ends)
    return at[inverse], np.searchsorted(starts, offsets)
