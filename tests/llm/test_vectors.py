"""Near-dedup and top-k search against all pairs."""

import duckdb
import numpy as np
import pytest

from skyledger.llm import neardup, topk
from skyledger.llm.components import roots

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(seed, rows=300, dims=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dims))
    out = []
    for i in range(rows):
        v = centres[rng.integers(30)] + rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.3, 0.4])
        out.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), int(rng.integers(3)) if i % 3 else 0))
    return out


ODD = [
    (1000, None, 0), (1001, [0.0] * 24, 0), (1002, [float("nan")] + [1.0] * 23, 0), (1003, [float("inf")] + [1.0] * 23, 0), (1050, [None] + [1.0] * 23, 0),
    (1100, [1.0] * 24, None), (1101, [1.0] * 24, 0), (1102, [2.0] * 24, 0), (1102, [2.0] * 24, 0), (None, [3.0] * 24, 0), (1103, [1.0, 2.0], 0), (1150, [1.0, 2.0], 0),
    (1104, [], 0), (1105, [3e38] * 24, 0), (1106, [1e-30] * 24, 0),
]


def brute(rows, threshold=0.93):
    def sound(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for i, (_, a, label) in enumerate(rows):
        for j in range(i):
            b, other = rows[j][1:]
            if sound(a, label) and sound(b, other) and label == other and len(a) == len(b):
                x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    links.append((i, j))
    a, b = np.array(links, int).reshape(-1, 2).T
    root = roots(len(rows), a, b)
    count = np.bincount(np.append(a, b), minlength=len(rows))
    smallest = {}
    for (vec_id, _, _), r in zip(rows, root, strict=True):
        if vec_id is not None:
            smallest[r] = min(smallest.get(r, vec_id), vec_id)
    return sorted(((v, int(n), smallest.get(r), v is not None and v == smallest.get(r)) for (v, _, _), n, r in zip(rows, count, root, strict=True)), key=repr)


@pytest.mark.parametrize("tile", [8192, 20])
def test_near_duplicates_equal_brute_force(spark, tile):
    rows = table(1) + ODD
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS n_links", "3 AS Label")
    found = [tuple(r) for r in neardup.near_duplicates(df, tile=tile).collect()]
    expected = brute(rows)
    assert sorted(found, key=repr) == expected
    assert sum(n for _, n, _, _ in expected) > 100


def test_suffix_bounds_drop_no_link():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 64)) * np.linspace(2, 0.1, 64)
    x[200:] = x[:200] + rng.normal(size=(200, 64)) * 0.15
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = neardup.compare(unit, unit, x, x, 0.93)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*(i.tolist() for i in np.nonzero(unit @ unit.T >= 0.93)), strict=True))


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert neardup.near_duplicates(df).count() == 0 and topk.top_k(df).count() == 0
    bad = spark.createDataFrame([(0, None, 1), (50, [float("nan")], 1)], SCHEMA)
    assert neardup.near_duplicates(bad).count() == 2 and topk.top_k(bad).count() == 0


def best(rows, k=5, every=50):
    sound = {(i, tuple(np.floor(256 * np.array(v, np.float32).astype(float)).tolist())) for i, v, _ in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, q in sound:
        if i % every == 0:
            scores = sorted((-int(np.dot(q, v)), j) for j, v in sound if j != i and len(v) == len(q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "query_rows": 3}])
def test_top_k_equals_brute_force(spark, options):
    rows = table(2) + [r for r in ODD if r[0] != 1105]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS VEC_ID")
    assert sorted(tuple(r) for r in topk.top_k(df, **options).collect()) == best(rows)


def test_blocks_are_left_out():
    rng = np.random.default_rng(7)
    rows = np.floor(256 * np.repeat(rng.normal(size=(40, 16)), 100, 0) + rng.normal(size=(4000, 16)))
    index = topk.BlockIndex(np.arange(4000), rows)
    bounds = index.bounds(rows[:5])
    for q, bound, (_, scores) in zip(rows[:5], bounds, index.search(np.arange(5), rows[:5], 5), strict=True):
        blocks = [rows[index.ids[i : i + 64]] @ q for i in range(0, 4000, 64)]
        assert all(b.max() <= limit for b, limit in zip(blocks, bound, strict=True))
        assert (bound < scores[-1]).mean() > 0.5


def test_sql_equals_brute_force():
    rows = [r for r in table(3) + ODD if r[0] not in (None, 1102)]
    db = duckdb.connect()
    db.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    db.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [r for r in rows if r[0] != 1105])
    rows = [r for r in rows if r[0] != 1105]
    assert sorted(db.sql(neardup.NEARDUP_SQL).fetchall(), key=repr) == brute(rows)
    assert sorted(db.sql(topk.TOP_K_SQL).fetchall()) == best(rows)
