"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from skyledger.llm import ragged

_SPACE = np.zeros(256, bool)
_SPACE[ragged.ASCII_SPACE] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every text, ascending within a text, and their numbers.

    Words are runs without ASCII white space, A-Z in lower case. A text with
    fewer than ``size`` words has its whole sequence as one shingle, a text
    without words has none.
    """
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.append(0, np.cumsum([len(d) for d in data], dtype=np.int64))
    letters = _LOWER[np.frombuffer(b"".join(data), np.uint8)]
    starts, ends = ragged.words(_SPACE[letters], offsets)
    words = np.append(ragged.span_hash(letters, starts, ends), np.zeros(size, np.uint64))
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    number = np.where(count >= size, count - size + 1, count > 0)
    at = ragged.gather(first[:-1], number)
    length = np.repeat(np.minimum(count, size), number)
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        value = ragged.mix(value + np.where(k < length, words[at + k], np.uint64(0)) + np.uint64(k))
    value = ragged.mix(value + length.astype(np.uint64))
    owner = np.repeat(np.arange(len(texts)), number)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts)).astype(np.int64)


def set_ids(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit id of every set that equal sets share."""
    held = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(ragged.mix(tokens ^ np.uint64(0xA0761D6478BD642F)), out=held[1:])
    edges = np.append(0, np.cumsum(sizes))
    return ragged.mix(held[edges[1:]] - held[edges[:-1]] + sizes.astype(np.uint64)).view(np.int64)
