"""Jaccard join against all pairs."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import jaccard
from skyledger.llm.components import components, roots
from skyledger.llm.shingles import set_ids, shingle_sets
from skyledger.llm.signature_tree import Join

SCHEMA = "doc_id long, text string"


def shingles(text, width=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    for space in "\t\n\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1)))


def linked(a, b):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= 80 * (len(a) + len(b) - common)


def brute(rows):
    """Component of every row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if linked(sets[i], sets[j])]
    root = roots(len(rows), np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int))
    smallest = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        if doc_id is not None:
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    return sorted(((d, len(s), smallest.get(r) if s else d) for (d, _), s, r in zip(rows, sets, root, strict=True)), key=repr)


def corpus(seed, families=12, passage=""):
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 8, 30, 120]))]
        for _ in range(rng.choice([1, 2, 9])):
            words = [w if rng.random() > rng.choice([0, 0.01, 0.04]) else f"x{rng.randrange(999)}" for w in base]
            rows.append((len(rows), " ".join(words) + (f" {passage}" if f % 2 else "")))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,tile", [(1, 2000), (2, 2000), (3, 3), (4, 1)])
def test_components_equal_brute_force(spark, seed, tile):
    rows = corpus(seed, passage=" ".join(f"p{i}" for i in range(25)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = [tuple(r) for r in jaccard.link_documents(df, tile=tile).collect()]
    assert sorted(found, key=repr) == brute(rows)


def test_sql_equals_brute_force():
    rows = corpus(5)
    documents = duckdb.values  # noqa: F841
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(db.sql(jaccard.LINK_SQL).fetchall(), key=repr) == brute(rows)


def test_odd_rows(odd, empty, clashing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = [tuple(r) for r in jaccard.link_documents(clashing(odd, "n_shingles", "component_id")).collect()]
    assert sorted(found, key=repr) == brute(rows)
    assert jaccard.link_documents(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0


def test_one_document_of_each_class_stays(odd):
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 8, 9]


def test_small_families_are_dealt_out_by_weight(spark):
    assert jaccard.shared_groups(1_999, 1_000, 2_000, 2_000_000) == 1
    assert jaccard.shared_groups(20_000, 1_000_000, 2_000, 2_000_000) == 20
    assert jaccard.shared_groups(1_000, 200_000_000, 2_000, 2_000_000) == 200
    rows = corpus(7)
    found = [tuple(r) for r in jaccard.link_documents(spark.createDataFrame(rows, SCHEMA), tile_tokens=300).collect()]
    assert sorted(found, key=repr) == brute(rows)


def near(start, changed=(), count=60):
    return " ".join("changed" if i in changed else f"n{start + i}" for i in range(count))


#: near copies under null and under one id, one of them equal to a text with an id of its own, and rows repeated as they are
SHARED_IDS = [(5, near(0)), (None, near(0, [59])), (None, near(0, [0])), (None, near(100)), (None, near(100, [59])), (None, near(100, [59])), (7, near(200)),
              (7, near(200, [0])), (7, near(300)), (6, near(300, [59])), (None, near(400)), (None, ""), (None, None), (9, near(500)), (9, near(500)), (8, near(500, [0]))]


@pytest.mark.parametrize("parts", [1, 4])
def test_ids_that_stand_for_several_texts(spark, parts):
    found = [tuple(r) for r in jaccard.link_documents(spark.createDataFrame(SHARED_IDS, SCHEMA).repartition(parts)).collect()]
    assert sorted(found, key=repr) == brute(SHARED_IDS)


def test_an_id_stays_with_each_class_it_is_smallest_of(spark):
    rows = [(3, near(0)), (3, near(0, [59])), (3, near(100)), (4, near(100, [0])), (2, near(200)), (3, near(200, [59]))]
    kept = [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(kept) == [(2, near(200)), (3, near(0, [59])), (3, near(100))]


def test_one_row_of_each_class_without_id(spark):
    kept = [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(SHARED_IDS, SCHEMA)).collect()]
    assert sorted(d for d, _ in kept if d is not None) == [5, 6, 7, 8]
    nameless = [t for d, t in kept if d is None]
    assert len(nameless) == 4 and {None, "", near(400)} <= set(nameless) and {near(100), near(100, [59])} & set(nameless)


def test_the_limit_itself_is_a_link(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(13))), (2, " ".join(f"a{i}" for i in range(12)) + " z"), (3, " ".join(f"a{i}" for i in range(11)))]
    # 9 shingles each, 8 common: 8 / 10; and 7 of 9
    found = {r.doc_id: r.component_id for r in jaccard.link_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def test_trees_with_sides_compare_across_only():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 60)
    sets = [np.unique(np.append(base[rng.random(60) > 0.03], rng.integers(0, 1 << 62, 1)).astype(np.uint64)) for _ in range(40)]
    sets += [np.unique(rng.integers(0, 1 << 62, int(n)).astype(np.uint64)) for n in rng.integers(1, 80, 40)]
    side = rng.integers(0, 2, len(sets))
    root = Join(np.concatenate(sets), np.array([len(s) for s in sets]), side=side).run()
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if side[i] != side[j] and (k := len(np.intersect1d(sets[i], sets[j]))) * 5 >= 4 * (len(sets[i]) + len(sets[j]) - k)]
    expected = roots(len(sets), *np.array(pairs).T)
    assert len(set(zip(root, expected, strict=True))) == len(set(root)) == len(set(expected))


def test_shingles_and_ids():
    tokens, sizes = shingle_sets(["a b c d e f", "A B\tC d  e f ", "a b", "", "a b c d e a b c d e"])
    assert sizes.tolist() == [2, 2, 1, 0, 5]
    ids = set_ids(tokens, sizes)
    assert ids[0] == ids[1] and len(set(ids.tolist())) == 4


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_a_shingle_of_all_documents_goes_out_once_per_chunk(spark, monkeypatch):
    """One passage in every document: its shingles travel once per chunk, and the result is that of all pairs."""
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, f"{passage} " + " ".join(f"w{(i // 2) * 40 + k}" for k in range(30 + i % 2))) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    sent = jaccard._deal(df.select("doc_id", "text", F.xxhash64("text").alias("text_key")), 8, 5).where(F.col("kind") == jaccard.TOKENS)
    numbers = [np.frombuffer(r.numbers, np.uint32) for r in sent.collect()]
    sizes = sum(len(shingles(t)) for _, t in rows)
    several = np.concatenate(numbers) >= jaccard.SEVERAL
    assert sum(map(len, numbers)) < 0.8 * sizes and several.any()
    assert sorted(map(tuple, jaccard.link_documents(df).collect()), key=repr) == brute(rows)


def test_parts_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 16)
    rows = corpus(5)
    seen = []
    real = jaccard._deal
    monkeypatch.setattr(jaccard, "_deal", lambda docs, bits, width: seen.append(bits) or real(docs, bits, width))
    assert sorted(map(tuple, jaccard.link_documents(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == brute(rows)
    assert seen[0] > 8
