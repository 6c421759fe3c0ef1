"""Packing token sequences of documents into windows of fixed size.

Method: best-fit decreasing. Overlong documents are first cut into full
windows; the rest are placed longest first, each into the open window with the
least room that still holds it, found by a segment tree over room sizes.

Packing runs inside groups of consecutive documents of a partition (bounded by
``group_tokens``), so that it needs neither a shuffle nor a global order;
a group holds thousands of documents, which is enough for tight windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skyledger.llm import bpe, ragged
from skyledger.llm.inputs import pick

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class RoomTree:
    """Segment tree over room sizes 0..size: which sizes have an open window."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, room: int, open_: bool) -> None:
        node = room + self.leaves
        tree = self.any
        tree[node] = open_
        node >>= 1
        while node:
            value = tree[2 * node] or tree[2 * node + 1]
            if tree[node] == value:
                return
            tree[node] = value
            node >>= 1

    def least(self, need: int) -> int:
        """The smallest room of at least ``need`` that is open, or -1."""
        node, tree = need + self.leaves, self.any
        if tree[node]:
            return need
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1


def best_fit(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of item numbers; every length is from 1 to ``window``."""
    tree, open_by_room = RoomTree(window), [[] for _ in range(window + 1)]
    windows: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[item]
        room = tree.least(need)
        if room < 0:
            number, room = len(windows), window
            windows.append([])
        else:
            number = open_by_room[room].pop()
            if not open_by_room[room]:
                tree.set(room, False)
        windows[number].append(item)
        left = room - need
        if left:
            open_by_room[left].append(number)
            if len(open_by_room[left]) == 1:
                tree.set(left, True)
    return windows


def plan(lengths: np.ndarray, window: int, max_padding: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document number, start, length) for documents of the given lengths.

    Windows that best fit leaves with more than ``max_padding`` free places are
    joined and cut anew into full windows, and what is left over at the very end
    into sequences whose lengths are powers of two, which need no padding.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    rests: list[tuple[int, int, int]] = []
    for number, length in enumerate(lengths.tolist()):
        for start in range(0, length - window + 1, window):
            sequences.append([(number, start, window)])
        if length % window:
            rests.append((number, length - length % window, length % window))
    loose: list[tuple[int, list[int]]] = []
    for members in best_fit([r[2] for r in rests], window):
        fill = sum(rests[i][2] for i in members)
        if window - fill > max_padding:
            loose.append((fill, members))
        else:
            sequences.append([rests[i] for i in members])
    stream = [rests[i] for _, members in sorted(loose, reverse=True) for i in members]
    left = sum(length for _, _, length in stream)
    room, current = 0, []
    for number, start, length in stream:
        while length:
            if not room:
                room = window if left >= window else 1 << (left.bit_length() - 1)
                current = []
                sequences.append(current)
            part = min(room, length)
            current.append((number, start, part))
            start, length, room, left = start + part, length - part, room - part, left - part
    return sequences


def pack(docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 2, max_padding: int = 16,
         group_tokens: int = 2_000_000) -> DataFrame:
    """One row per piece: the piece of which document, its ids (unsigned 32-bit, little-endian) and its place.

    Every document's ids, with ``end_id`` behind them, lie in its pieces exactly
    once; ``sequence_id`` and ``offset`` give the place, offsets are gapless from
    0. A null text is an empty document, which has the end id alone; a null
    doc_id stays null; repeated rows are packed each for itself; an empty table
    gives no rows; other columns are left out. Sequence ids follow the
    partitioning of the input.
    """

    def flush(doc_ids: list, ids: list[np.ndarray], first: int, task: int) -> tuple[pa.RecordBatch, int]:
        sequences = plan(np.array([len(i) for i in ids], np.int64), window, max_padding)
        rows: list[tuple] = []
        for k, sequence in enumerate(sequences):
            offset = 0
            for number, start, length in sequence:
                data = ids[number][start : start + length].tobytes()
                rows.append((doc_ids[number], start, length, zlib.crc32(data), len(ids[number]), (task << 32) + first + k, offset, data))
                offset += length
        columns = list(zip(*rows, strict=True))
        types = [pa.int64()] * 7 + [pa.binary()]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names), first + len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        doc_ids, held, size, first = [], [], 0, 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys = batch.column(0).to_pylist()
            for a, b in ragged.chunks(texts):
                ids, lengths = bpe.encode(texts[a:b], vocabulary)
                ends = np.cumsum(lengths)
                closed = np.insert(ids.astype("<u4"), ends, end_id)
                held += np.split(closed, ends[:-1] + np.arange(1, len(ends)))
                doc_ids += keys[a:b]
                size += len(closed)
                if size >= group_tokens:
                    out, first = flush(doc_ids, held, first, task)
                    yield out
                    doc_ids, held, size = [], [], 0
        if held:
            yield flush(doc_ids, held, first, task)[0]

    return pick(docs, doc_id="long", text="string").mapInArrow(ragged.tidy(run), SCHEMA)
