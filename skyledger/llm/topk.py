"""Exact top-k search by integer inner product with block-at-a-time pruning.

Candidates are dealt to shards, and in a shard put into document-range blocks of
alike vectors. A block keeps, per term (a dimension and a sign), the largest
impact of its documents; the sum of these maxima over a query's terms bounds
every score in the block. A query takes the blocks in the order of this bound,
scores whole blocks through their forward index (the rows of the block) and
stops as soon as the next bound is below its k-th score.

A shard's index is built once, in the task that has its rows; queries stream
past it, a bounded number at a time, and leave at most k rows each.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.inputs import pick, stored
from skyledger.llm.vectors import matrix, usable


def range_order(rows: np.ndarray, block: int) -> np.ndarray:
    """An order of the rows in which each run of ``block`` rows is alike: halves along the widest dimension, again and again."""
    done, todo = [], [np.arange(len(rows))]
    while todo:
        part = todo.pop()
        if len(part) <= block:
            done.append(part)
            continue
        own = rows[part]
        widest = int(own.var(0).argmax())
        half = -(-len(part) // (2 * block)) * block
        order = np.argpartition(own[:, widest], half - 1) if half < len(part) else np.arange(len(part))
        todo += [part[order[half:]], part[order[:half]]] if half < len(part) else []
        if half >= len(part):
            done.append(part)
    return np.concatenate(done) if done else np.zeros(0, np.int64)


class BlockIndex:
    """Forward index in blocks, and the largest impact of every term in every block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, block: int = 64):
        order = range_order(rows, block)
        self.ids, self.rows, self.block = ids[order], rows[order], block
        starts = np.arange(0, len(rows), block)
        self.most, self.least = np.maximum.reduceat(self.rows, starts), np.minimum.reduceat(self.rows, starts)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every query and block the sum of the term maxima."""
        return np.maximum(queries, 0) @ self.most.T + np.minimum(queries, 0) @ self.least.T

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every query the ids and scores of its k best rows, ties to smaller ids, rows with the query's own id left out."""
        out = []
        bounds = self.bounds(queries)
        order = np.argsort(-bounds, axis=1, kind="stable")
        for own, query, bound, blocks in zip(query_ids, queries, bounds, order, strict=True):
            ids, scores = np.zeros(0, np.int64), np.zeros(0, queries.dtype)
            at, wave = 0, 4
            while at < len(blocks) and (len(ids) < k or bound[blocks[at]] >= scores[-1]):
                some = blocks[at : at + wave]
                if len(ids) == k:
                    some = some[bound[some] >= scores[-1]]
                rows = (some[:, None] * self.block + np.arange(self.block)[None, :]).ravel()
                rows = rows[rows < len(self.ids)]
                found = self.rows[rows] @ query
                use = self.ids[rows] != own
                if len(ids) == k:
                    use &= found >= scores[-1]
                ids, scores = np.append(ids, self.ids[rows[use]]), np.append(scores, found[use])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                at, wave = at + wave, wave * 2
            out.append((ids, scores))
        return out


def _exact(own: int, query: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """The k best of the rows by whole numbers of any size."""
    whole = [int(x) for x in query]
    scores = [(-sum(a * int(b) for a, b in zip(whole, row)), int(i)) for i, row in zip(ids, rows) if i != own]
    best = heapq.nsmallest(k, scores)
    return np.array([i for _, i in best], np.int64), [-s for s, _ in best]


class Shard:
    """Candidates of a shard: those whose scores fit 64 bits in blocks, the few wider ones beside them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.rows, self.k, dims = ids, rows, k, rows.shape[1]
        # up to this size products of two rows add up to less than 2^63, or 2^53, below which doubles are exact
        self.narrow, self.exact = math.isqrt(2**62 // dims), math.isqrt(2**52 // dims)
        size = np.abs(rows).max(1)
        self.wide = size > self.narrow
        kept = rows[~self.wide]
        self.small = not len(kept) or size[~self.wide].max() <= self.exact
        self.index = BlockIndex(ids[~self.wide], kept if self.small else kept.astype(np.int64)) if len(kept) else None

    def search(self, query_ids: np.ndarray, queries: np.ndarray) -> list[tuple[np.ndarray, list[int]]]:
        size = np.abs(queries).max(1)
        wide = size > self.narrow
        answers: list = [(np.zeros(0, np.int64), [])] * len(queries)
        kept = np.flatnonzero(~wide)
        if self.index is not None and len(kept):
            asked = queries[kept]
            if not self.small or size[kept].max() > self.exact:
                asked, self.index.rows = asked.astype(np.int64), self.index.rows.astype(np.int64)
                self.index.most, self.index.least = self.index.most.astype(np.int64), self.index.least.astype(np.int64)
                self.small = False
            for i, (ids, scores) in zip(kept, self.index.search(query_ids[kept], asked, self.k)):
                answers[i] = ids, [int(s) for s in scores]
        for i in np.flatnonzero(wide) if not self.wide.any() else range(len(queries)):
            others = np.ones(len(self.ids), bool) if wide[i] else self.wide
            ids, scores = _exact(query_ids[i], queries[i], self.ids[others], self.rows[others], self.k)
            both = sorted(zip([*answers[i][1], *scores], [*answers[i][0], *ids]), key=lambda a: (-a[0], a[1]))[: self.k]
            answers[i] = np.array([n for _, n in both], np.int64), [s for s, _ in both]
        if any(not -(2**63) <= s < 2**63 for _, scores in answers for s in scores):
            raise OverflowError("a score of the best rows does not fit 64 bits")
        return answers


ANSWERS = "query_id long, query long, vec_id long, score long"


def _search_shards(k: int, query_rows: int):
    """Over rows in order of shard, candidates ahead of queries: the index of a shard is built once, queries stream past it."""

    def answer(shard: Shard, waiting: list[tuple]) -> pa.RecordBatch:
        ids = np.array([w[0] for w in waiting], np.int64)
        found = shard.search(ids, np.array([w[1] for w in waiting], np.float64))
        return pa.RecordBatch.from_pydict({
            "query_id": pa.array(np.repeat(ids, [len(f[0]) for f in found])), "query": pa.array(np.repeat(np.array([w[2] for w in waiting], np.int64), [len(f[0]) for f in found])),
            "vec_id": pa.array(np.concatenate([f[0] for f in found])), "score": pa.array([s for f in found for s in f[1]], pa.int64()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, blocks, shard, waiting = None, [], [], None, []
        for batch in batches:
            dims, numbers, flags = (np.array(batch.column(c)) for c in ("dims", "shard", "asked"))
            edges = np.flatnonzero(np.append(True, (dims[1:] != dims[:-1]) | (numbers[1:] != numbers[:-1]) | (flags[1:] != flags[:-1])))
            for a, b in zip(edges, np.append(edges[1:], len(dims))):
                if (dims[a], numbers[a]) != at:
                    if shard is not None and waiting:
                        yield answer(shard, waiting)
                    at, ids, blocks, shard, waiting = (dims[a], numbers[a]), [], [], None, []
                part = batch.slice(a, b - a)
                rows = matrix(part.column("vector"), int(dims[a]))
                if not flags[a]:
                    ids.append(np.array(part.column("vec_id"), np.int64))
                    blocks.append(rows)
                elif blocks or shard is not None:
                    if shard is None:
                        shard, ids, blocks = Shard(np.concatenate(ids), np.concatenate(blocks), k), [], []
                    waiting += zip(part.column("vec_id").to_pylist(), rows, part.column("hashed").to_pylist())
                    while len(waiting) >= query_rows:
                        yield answer(shard, waiting[:query_rows])
                        waiting = waiting[query_rows:]
        if shard is not None and waiting:
            yield answer(shard, waiting)

    return run


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256, shard_rows: int = 65_536, query_rows: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows.

    Components become floor(scale * x); the score is the integer inner product,
    ties go to the smaller vec_id. Queries are the rows whose vec_id is divisible
    by ``every``, candidates all rows but those with the query's own vec_id.
    Vectors that are null or empty or hold null or non-finite components take no
    part, nor do rows without a vec_id, nor components that ``scale`` makes
    infinite; vectors of other length than the query's are no candidates.
    Repeated rows count once. With fewer than k candidates all are returned, with
    none no row. Other columns are left out. Scores are exact whatever their
    size; one among the k best that does not fit 64 bits raises OverflowError.

    Every candidate is shuffled once, to its shard; queries go to all shards.
    """
    spark = embeddings.sparkSession
    sound = pick(embeddings, vec_id="long", embedding="array<double>").where(F.col("vec_id").isNotNull()).where(usable(F.col("embedding")))
    # doubles from 2^52 on are whole numbers already, and may be too large for a long
    floor = lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale)
    whole = sound.select("vec_id", F.transform("embedding", floor).alias("vector")).where(usable(F.col("vector"))).dropDuplicates()
    whole = stored(whole.withColumn("dims", F.size("vector")))
    rows = whole.count()
    # as many shards as tasks run at once, more where these would be too large
    shards = max(1, -(-rows // shard_rows), min(spark.sparkContext.defaultParallelism, rows // 2048))
    hashed = F.xxhash64("vec_id", "vector")
    common = ["vec_id", "vector", "dims", hashed.alias("hashed")]
    given = whole.select(*common, F.lit(False).alias("asked"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"))
    asked = whole.where(F.col("vec_id") % every == 0).select(*common, F.lit(True).alias("asked"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    dealt = given.unionByName(asked).repartition(shards, "shard", "dims").sortWithinPartitions("shard", "dims", "asked")
    found = dealt.mapInArrow(_search_shards(k, query_rows), ANSWERS)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH sound AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
QUALIFY rank <= 5
"""
