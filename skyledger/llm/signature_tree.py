"""Jaccard join of token sets in one task by dual traversal of a signature tree.

Leaves are sets, ordered so that alike ones stand side by side; a node holds the
OR of the token bitmaps below it, the range of set sizes, and the largest number
of tokens that share a bit with another token of their set. For sets A and B

    overlap(A, B) <= popcount(A & B) + min(shared_A, shared_B),

and the same holds for nodes, so a pair of nodes is left out when this falls
short of what the smallest sets below them would need, or when their sizes are
too far apart.
"""

from __future__ import annotations

import numpy as np

from skyledger.llm import components, ragged

PAIRS = 100_000


class Level:
    def __init__(self, bits: np.ndarray, small: np.ndarray, large: np.ndarray, shared: np.ndarray):
        self.bits, self.small, self.large, self.shared = bits, small, large, shared

    def parent(self) -> Level:
        starts = np.arange(0, len(self.small), 2)
        return Level(np.bitwise_or.reduceat(self.bits, starts), np.minimum.reduceat(self.small, starts),
                     np.maximum.reduceat(self.large, starts), np.maximum.reduceat(self.shared, starts))


def bitmaps(tokens: np.ndarray, owner: np.ndarray, count: int, width: int) -> np.ndarray:
    place = (ragged.mix(tokens) >> np.uint64(20)) & np.uint64(width - 1)
    cells = np.unique(owner.astype(np.uint64) * np.uint64(width) + place)
    words = np.zeros(count * (width // 64), np.uint64)
    np.bitwise_or.at(words, (cells >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cells & np.uint64(63)))
    return words.reshape(count, -1)


class Join:
    """Links of similarity >= numerator / denominator among sets, as a union of components.

    ``cross`` marks each set with a side; if given, only pairs of different sides are compared.
    """

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, numerator: int = 4, denominator: int = 5, side: np.ndarray | None = None):
        self.num, self.den = numerator, denominator
        count = len(sizes)
        begin = np.cumsum(sizes) - sizes
        first = tokens[begin]
        # bands of sizes, then the smallest token, which alike sets mostly share
        band = np.floor(np.log(sizes) / np.log(denominator / numerator)).astype(np.int64)
        self.order = np.lexsort((sizes, first, band))
        self.sizes = sizes[self.order]
        self.begin = begin[self.order]
        self.tokens = np.unique(tokens, return_inverse=True)[1]
        self.vocabulary = int(self.tokens.max()) + 1 if len(tokens) else 0
        self.side = np.zeros(count, np.int64) if side is None else side[self.order]
        self.crossing = side is not None
        self.label = np.arange(count)
        width = 1 << int(np.clip(np.ceil(np.log2(8 * max(sizes.mean(), 1))), 8, 13))
        owner = np.repeat(np.arange(count), self.sizes)
        bits = bitmaps(tokens[ragged.gather(self.begin, self.sizes)], owner, count, width)
        shared = self.sizes - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [Level(bits, self.sizes, self.sizes, shared)]
        while len(self.levels[-1].small) > 1:
            self.levels.append(self.levels[-1].parent())

    def possible(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = self.levels[level]
        fits = (self.num * at.small[x] <= self.den * at.large[y]) & (self.num * at.small[y] <= self.den * at.large[x])
        left = np.flatnonzero(fits)
        need = self.num * (at.small[x[left]] + at.small[y[left]])
        spare = np.minimum(at.shared[x[left]], at.shared[y[left]])
        words = at.bits.shape[1]
        step = max(1, 1_000_000 // words)
        bound = np.concatenate([
            np.bitwise_count(at.bits[x[left[k : k + step]]] & at.bits[y[left[k : k + step]]]).sum(1).astype(np.int64) for k in range(0, len(left), step)
        ]) if len(left) else np.zeros(0, np.int64)
        fits[left] = (self.num + self.den) * (bound + spare) >= need
        return fits

    def verify(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs of leaves are links, by counting their common tokens."""
        out = np.zeros(len(x), bool)
        mark = np.zeros(self.vocabulary, bool)
        order = np.argsort(x, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(x[order], prepend=-1)), len(x))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            some, left = order[a:b], x[order[a]]
            mine = self.tokens[self.begin[left] : self.begin[left] + self.sizes[left]]
            mark[mine] = True
            for k in range(0, len(some), 4096):
                part = some[k : k + 4096]
                sizes = self.sizes[y[part]]
                common = np.add.reduceat(mark[self.tokens[ragged.gather(self.begin[y[part]], sizes)]].astype(np.int64), np.cumsum(sizes) - sizes)
                out[part] = self.den * common >= self.num * (self.sizes[left] + sizes - common)
            mark[mine] = False
        return out

    def _settle(self, x: np.ndarray, y: np.ndarray) -> None:
        """Compare the given leaves and join the components of those that are links."""
        use = (self.label[x] != self.label[y]) & ~(self.crossing & (self.side[x] == self.side[y]))
        x, y = x[use], y[use]
        use = self.possible(0, x, y)
        x, y = x[use], y[use]
        use = self.verify(x, y)
        self.label = components.roots(len(self.label), np.append(x[use], np.arange(len(self.label))), np.append(y[use], self.label))

    def _uniform(self) -> list[np.ndarray]:
        """Per level and node the component that holds all leaves below, or -1."""
        low = high = self.label
        out = [low]
        for _ in self.levels[1:]:
            starts = np.arange(0, len(low), 2)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            out.append(np.where(low == high, low, -1))
        return out

    def run(self) -> np.ndarray:
        """For each set, in the order given, the number of a set that stands for its component."""
        count = len(self.sizes)
        for gap in (1, 2, 4):  # neighbours first: most components are complete after this
            self._settle(np.arange(max(count - gap, 0)), np.arange(max(count - gap, 0)) + gap)
        self._descend(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))
        out = np.empty(count, np.int64)
        out[self.order] = self.order[self.label]
        return out

    def _descend(self, level: int, x: np.ndarray, y: np.ndarray) -> None:
        """Depth first over slices of the frontier, so that its size stays bounded and finished components save later work."""
        stack = [(level, x, y)]
        while stack:
            level, x, y = stack.pop()
            uniform = self._uniform()[level]
            use = ~((uniform[x] >= 0) & (uniform[x] == uniform[y]))
            x, y = x[use], y[use]
            if not len(x):
                continue
            if not level:
                self._settle(x, y)
                continue
            use = (x == y) | self.possible(level, x, y)
            x, y = x[use], y[use]
            below = len(self.levels[level - 1].small)
            kids = [(2 * x + i, 2 * y + j, (2 * x + i < below) & (2 * y + j < below) & ((x < y) | (i <= j))) for i in (0, 1) for j in (0, 1)]
            x = np.concatenate([k[0][k[2]] for k in kids])
            y = np.concatenate([k[1][k[2]] for k in kids])
            if level == 1:
                use = x != y
                x, y = x[use], y[use]
            order = np.lexsort((y, x))
            x, y = x[order], y[order]
            stack += [(level - 1, x[k : k + PAIRS], y[k : k + PAIRS]) for k in range(0, len(x), PAIRS)][::-1]
