"""Collocations against plain counting."""

import pickle
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from skyledger.llm import collocations as col


def plain(docs, longest=3, threshold=10, covered=50, first=2000):
    counts, totals = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                f.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    rows = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        listed = []
        for p, a in candidates.items():
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= covered * a for b in longer):
                listed.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:first], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def drawn(seed, docs=120, words=12):
    draw = random.Random(seed)
    vocabulary = [f"W{i}é" for i in range(words)] + ["a", "B", "it's"]
    return [("".join(draw.choice(vocabulary) + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(draw.randint(0, 80))),
             draw.choice(["en", "de", None])) for _ in range(docs)]


def found(spark, docs, **options):
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(docs)], "doc_id long, text string, lang string").repartition(4)
    return sorted(map(tuple, col.collocations(df, **options).collect()))


# small partitions make the summaries prune, small bitmaps make n-grams share bits
@pytest.mark.parametrize("options", [{}, {"partition_mass": 500, "bitmap_bits": 10}, {"longest": 4, "threshold": 5, "partition_mass": 100}, {"first": 7, "covered": 90}])
def test_equals_plain_counting(spark, options):
    docs = drawn(1)
    assert found(spark, docs, **options) == plain(docs, **{k: v for k, v in options.items() if k not in ("partition_mass", "bitmap_bits")})


@pytest.mark.parametrize("options", [{}, {"partition_mass": 500}, {"partition_mass": 500, "bitmap_bits": 10}])
def test_the_bitmap_passes_the_driver_small_and_misses_no_frequent_gram(spark, options):
    docs = drawn(4)
    letters, lang = sum(len((t or "").encode()) for t, _ in docs), [g or "und" for _, g in docs]
    df = spark.createDataFrame(list(zip([t for t, _ in docs], lang)), "text string, lang string").repartition(4)
    bitmap = col.frequent_bitmap(df, letters, 3, 10, **options)
    assert len(pickle.dumps(bitmap)) < letters
    bits = bitmap.opened()
    assert 8 * len(bits) == 1 << bitmap.size
    met = Counter(int(h) for _, value in col.gram_hashes(col.tokens([(t or "").encode() for t, _ in docs], lang), 3) for h in value)
    frequent = [h >> 64 - bitmap.size for h, n in met.items() if n >= 10]
    assert frequent and all(bits[b >> 3] >> (b & 7) & 1 for b in frequent)


def test_a_bitmap_without_stretches_has_no_bits():
    assert not col.Bitmap(12, 9, {}).opened().any()


def test_small_chunks_and_buffers_give_the_same(spark, monkeypatch):
    docs = drawn(2)
    monkeypatch.setattr(col, "BUFFER", 50)
    hashes = [h for c in col._chunks(iter([])) for h in col.gram_hashes(c, 3)]
    assert hashes == [] and found(spark, docs) == plain(docs)


@pytest.mark.parametrize("seed", range(4))
def test_every_frequent_key_survives(seed):
    draw = np.random.default_rng(seed)
    stream = np.concatenate([draw.integers(0, 5000, 4000), np.repeat(draw.integers(0, 5000, 30), 9)]).astype(np.uint32)
    draw.shuffle(stream)
    parts = [np.unique(p, return_counts=True) for p in np.array_split(stream, 50)]
    keys, counts = np.unique(stream, return_counts=True)
    kept = col.survivors([(k, c.astype(np.int64)) for k, c in parts], 10)
    assert set(keys[counts >= 10]) <= set(kept) and len(kept) < len(keys)


def test_a_summary_never_holds_more_than_its_capacity():
    keys, counts, lowered = col.merge(np.arange(100, dtype=np.uint32), np.arange(1, 101), np.arange(50, 150, dtype=np.uint32), np.ones(100, np.int64), 20)
    assert len(keys) <= 20 and lowered == 81 and counts.min() > 0


def test_odd_rows(spark, odd, empty, clashing):
    assert col.collocations(empty).collect() == []
    docs = [(r.text, r.lang) for r in odd.collect()]
    assert sorted(map(tuple, col.collocations(odd, threshold=2).collect())) == plain(docs, threshold=2)
    assert sorted(map(tuple, col.collocations(clashing(odd, "rank", "phrase", "Lang"), threshold=2).collect())) == plain(docs, threshold=2)


def test_exact_beyond_64_bits(spark):
    """a * a * 10^6 and l * r pass 64 bits; the score is that of whole numbers."""
    a, left, right = 3_000_000_007, 3_000_000_019, 3_000_000_011
    assert spark.sql(
        f"SELECT cast(1000000 as decimal(38,0)) * cast({a}L as decimal(38,0)) * cast({a}L as decimal(38,0)) div (cast({left}L as decimal(38,0)) * cast({right}L as decimal(38,0)))"
    ).first()[0] == 10**6 * a * a // (left * right)


def test_sql_equals_plain_counting():
    docs = drawn(3) + [(None, "en"), ("", None)]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    assert sorted(db.sql(col.COLLOCATIONS_SQL).fetchall()) == plain(docs)
