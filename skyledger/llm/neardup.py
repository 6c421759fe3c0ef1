"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are turned into the frame of the principal axes of their second
moments, the axes of most weight first. Pairs are compared tile against tile:
products over the leading axes are accumulated first, what the other axes can
still add is at most the product of the suffix norms, and pairs that cannot
reach the threshold are dropped step by step. The few that remain are decided by
the cosine of the vectors as they are given.

Only vectors of one label and length meet. A label is cut into cells along the
first axis, as wide as two linked vectors can differ there, and large cells into
tiles, so a label with a third of all rows is work for many tasks. A tile pair
returns counts and a spanning forest of its links, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import components, roots
from skyledger.llm.inputs import pick, stored
from skyledger.llm.vectors import matrix, scaled, usable

BLOCK = 1024
SLACK = 1e-9


def principal_axes(vectors: DataFrame, most_lengths: int = 8) -> dict[int, np.ndarray]:
    """For the most frequent vector lengths the principal axes, in columns, most weight first.

    Sums of products are added up per task and then per cell of the matrix; a
    driver holds one matrix of length x length numbers for each of at most
    ``most_lengths`` lengths.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for batch in batches:
            dims = np.array(batch.column(0))
            for d in np.unique(dims):
                x = scaled(matrix(batch.column(1).filter(pa.array(dims == d)), int(d)))
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
                count[int(d)] = count.get(int(d), 0) + len(x)
        for d, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([count[d]]), pa.array([total.ravel()], pa.list_(pa.float64()))], names=["dims", "n", "cells"])

    parts = vectors.select("dims", "vector").mapInArrow(run, "dims int, n long, cells array<double>")
    common = [r.dims for r in vectors.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(most_lengths).collect()]
    cells = parts.where(F.col("dims").isin(common)).select("dims", F.posexplode("cells")).groupBy("dims", "pos").agg(F.sum("col").alias("value"))
    axes = {}
    for d, own in cells.toPandas().groupby("dims") if common else []:
        moments = own.sort_values("pos")["value"].to_numpy().reshape(int(d), int(d))
        axes[int(d)] = np.linalg.eigh(moments)[1][:, ::-1].copy()
    return axes


def compare(x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of x and y whose cosine reaches the threshold; x and y are unit vectors on principal axes."""
    dims = x.shape[1]
    steps = [*(s for s in (4, 8, 16, 32, 64, 128, 256, 512) if s < dims), dims]
    product = x[:, : steps[0]] @ y[:, : steps[0]].T
    rest_x = [np.sqrt(np.maximum((x[:, s:] ** 2).sum(1), 0)) for s in steps]
    rest_y = [np.sqrt(np.maximum((y[:, s:] ** 2).sum(1), 0)) for s in steps]
    live = product + np.outer(rest_x[0], rest_y[0]) >= threshold - SLACK
    a = b = None
    for k in range(1, len(steps)):
        part = slice(steps[k - 1], steps[k])
        if a is None and live.mean() > 0.1:  # most pairs are open: go on with whole products
            product += x[:, part] @ y[:, part].T
            live &= product + np.outer(rest_x[k], rest_y[k]) >= threshold - SLACK
            continue
        if a is None:
            a, b = np.nonzero(live)
            held = product[a, b]
        more = np.concatenate([np.einsum("ij,ij->i", x[a[i : i + 100_000], part], y[b[i : i + 100_000], part]) for i in range(0, len(a), 100_000)] or [np.zeros(0)])
        held = held + more
        use = held + rest_x[k][a] * rest_y[k][b] >= threshold - SLACK
        a, b, held = a[use], b[use], held[use]
    if a is None:
        a, b = np.nonzero(live)
        held = product[a, b]
    near = np.flatnonzero(held < threshold + SLACK)
    if len(near):
        left, right = raw_x[a[near]], raw_y[b[near]]
        cosine = (left * right).sum(1) / (np.sqrt((left * left).sum(1)) * np.sqrt((right * right).sum(1)))
        use = np.ones(len(a), bool)
        use[near] = cosine >= threshold
        a, b = a[use], b[use]
    return a, b


def _tile_links(table: pa.Table, axes: dict[int, np.ndarray], threshold: float) -> pa.Table:
    dims = table.column("dims")[0].as_py()
    raw = scaled(matrix(table.column("vector"), dims))
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    turned = unit @ axes[dims] if dims in axes else unit
    keys, weight = np.array(table.column("key"), np.int64), np.array(table.column("weight"), np.int64)
    left = np.array(table.column("left"), bool)
    same = bool(table.column("same")[0].as_py())
    rows = np.arange(len(keys)) if same else np.flatnonzero(left)
    others = rows if same else np.flatnonzero(~left)
    links = np.zeros(len(keys), np.int64)
    label = np.arange(len(keys))
    for i in range(0, len(rows), BLOCK):
        for j in range(i if same else 0, len(others), BLOCK):
            p, q = rows[i : i + BLOCK], others[j : j + BLOCK]
            a, b = compare(turned[p], turned[q], raw[p], raw[q], threshold)
            if same and i == j:
                a, b = a[a < b], b[a < b]
            a, b = p[a], q[b]
            links += np.bincount(a, weight[b], len(keys)).astype(np.int64) + np.bincount(b, weight[a], len(keys)).astype(np.int64)
            label = roots(len(keys), np.append(a, np.arange(len(keys))), np.append(b, label))
    found = links > 0
    return pa.table({"key": keys[found], "links": links[found], "root": keys[label[found]]})


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, tile: int = 8192) -> DataFrame:
    """One row per row of the table: vec_id, n_links, component_id, kept.

    Two vectors are linked when their labels are equal and not null, their
    lengths are equal and the cosine in double precision is at least
    ``threshold``. A vector that is null, empty or all zero, or that holds a null
    or non-finite component, is linked with nothing and is its own component.
    Repeated rows are linked with each other and count one by one. A null vec_id
    takes part in links but is never the smallest id. Other columns are left out;
    an empty table gives no rows. Rows are told apart by a 64-bit hash of id,
    vector and label; two of n different rows share one with odds of n^2 / 2^65.
    """
    kinds = {name: kind for name, kind in embeddings.dtypes}
    rows = pick(embeddings, vec_id="long", embedding="array<double>", label=kinds["label"] if kinds["label"] in ("int", "bigint") else "string")
    rows = rows.select("vec_id", F.col("embedding").alias("vector"), "label").withColumn("key", F.xxhash64("vec_id", "vector", "label"))
    nonzero = F.exists("vector", lambda x: x != 0)
    sound = rows.where(usable(F.col("vector")) & F.col("label").isNotNull()).where(nonzero)
    single = sound.groupBy("key").agg(F.count("*").alias("weight"), F.first("label").alias("label"), F.first("vector").alias("vector")).withColumn("dims", F.size("vector"))
    single = stored(single)
    axes = principal_axes(single)
    width = float(np.sqrt(2 * (1 - threshold)) + 1e-6)
    first_axis = {d: a[:, 0] for d, a in axes.items()}

    @F.pandas_udf("long")
    def cell(vectors):
        import pandas as pd

        out = []
        for v in vectors:
            v = np.asarray(v, np.float64)
            v = v / np.abs(v).max()
            axis = first_axis.get(len(v))
            out.append(int(np.floor((v @ axis if axis is not None else v[0]) / np.linalg.norm(v) / width)))
        return pd.Series(out, dtype="int64")

    placed = stored(single.withColumn("cell", cell("vector")))
    tiles = placed.groupBy("label", "dims", "cell").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    after = tiles.select("label", "dims", (F.col("cell") - 1).alias("cell"), F.col("tiles").alias("tiles_after"))
    before = tiles.select("label", "dims", (F.col("cell") + 1).alias("cell"), F.col("tiles").alias("tiles_before"))
    known = tiles.join(after, ["label", "dims", "cell"], "left").join(before, ["label", "dims", "cell"], "left")
    number = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    pair = lambda low, high, x, y, left: F.struct(low.alias("low"), high.alias("high"), x.alias("x"), y.alias("y"), left.alias("left"))
    here, mine = F.col("cell"), F.col("tile")
    partners = F.concat(
        F.transform(number("tiles"), lambda o: pair(here, here, F.least(mine, o), F.greatest(mine, o), mine <= o)),
        F.when(F.col("tiles_after").isNotNull(), F.transform(number("tiles_after"), lambda o: pair(here, here + 1, mine, o, F.lit(True)))).otherwise(F.array()),
        F.when(F.col("tiles_before").isNotNull(), F.transform(number("tiles_before"), lambda o: pair(here - 1, here, o, mine, F.lit(False)))).otherwise(F.array()),
    )
    dealt = (
        placed.join(known, ["label", "dims", "cell"]).withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")))
        .select("label", "dims", "key", "weight", "vector", F.explode(partners).alias("p")).select("label", "dims", "key", "weight", "vector", "p.*")
        .withColumn("same", (F.col("low") == F.col("high")) & (F.col("x") == F.col("y")))
    )
    found = stored(dealt.groupBy("label", "dims", "low", "high", "x", "y").applyInArrow(
        lambda table: _tile_links(table, axes, threshold), "key long, links long, root long"))
    linked = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "root")
    counted = found.groupBy("key").agg(F.sum("links").alias("links")).join(linked, "key", "left")
    repeats = single.select("key", "weight")
    full = (
        rows.select("vec_id", "key").join(repeats, "key", "left").join(counted, "key", "left")
        .select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links"), F.coalesce("root", "key").alias("root"),
                F.col("weight").isNotNull().alias("sound"))
    )
    full = stored(full)
    smallest = full.where("sound").groupBy("root").agg(F.min("vec_id").alias("smallest"))
    return (
        full.join(smallest, "root", "left")
        .select("vec_id", F.col("n_links").cast("long"), F.when(F.col("sound"), F.col("smallest")).otherwise(F.col("vec_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


NEARDUP_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.y FROM reach r JOIN links l ON r.b = l.x
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) k ON k.x = e.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = e.vec_id
"""
