"""Mixing against a plain reckoning of the same sampling."""

import duckdb
import pytest

from skyledger.llm import mixing


def targets(sizes):
    """Excess over the bounds is shared again and again until none is left."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    pool, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        if not open_:
            return fixed
        left = pool - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def check(rows, sources):
    sizes = {}
    for r in rows:
        sizes[sources[r.doc_id, r.size]] = sizes.get(sources[r.doc_id, r.size], 0) + r.size
    expected = targets(sizes)
    taken = {}
    for r in rows:
        source = sources[r.doc_id, r.size]
        assert r.source_size == sizes[source] and r.target == pytest.approx(expected[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] = taken.get(source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 0.5


def test_sources_meet_their_targets(spark):
    docs = [(i, " ".join(["w"] * (i * 7 % 40)), ["a", "b", "c", None, "d"][i % 5 if i % 3 else 0]) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    check(rows, {(i, len(t.split())): s for i, t, s in docs})
    assert sorted(rows) == sorted(mixing.mix(df.repartition(7)).collect())
    assert sorted(rows) == sorted(mixing.mix(df, slices=2).collect())
    assert sorted(r.taken for r in mixing.mix(df, seed="other").collect()) != sorted(r.taken for r in rows)


def test_result_equals_sql(spark):
    docs = [(i % 50, " ".join(["w"] * (i % 9)), f"s{i % 4}") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    documents = df.toArrow()  # noqa: F841
    expected = duckdb.sql(f"SELECT doc_id, size, source_size, target, taken, whole_copies FROM ({mixing.MIX_SQL})").fetchall()
    rows = [(r.doc_id, r.size, r.source_size, r.target, r.taken, r.whole_copies) for r in mixing.mix(df).collect()]
    assert sorted(rows) == sorted(expected)


def test_odd_rows(odd, empty, clashing):
    rows = mixing.mix(clashing(odd, "taken", "target")).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_only_whole_texts_leave_the_stage(spark):
    # long tail: most sources have one document
    docs = [(i, " ".join(f"w{k}" for k in range(1 + i % 17)), "en", f"s{min(i, 40)}", 5) for i in range(70)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    made = mixing.mixed_documents(df, whole_only=True)
    assert made.columns == df.columns
    rows = made.collect()
    assert {tuple(r) for r in rows} <= set(docs)
    words, largest = {}, {}
    for r in rows:
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    for _, text, _, source, _ in docs:
        largest[source] = max(largest.get(source, 0), len(text.split()))
    for r in mixing.mix(df, carry={"source": "string"}).select("source", "target").distinct().collect():
        assert abs(words.get(r.source, 0) - r.target) <= largest[r.source] / 2 + 0.5
    import corpus_pipeline
    assert {tuple(r) for r in dict(corpus_pipeline.STAGES)["mixing"](spark, df, "").collect()} <= set(docs)


def test_documents_come_as_often_as_taken(spark):
    docs = [(i, " \n".join(f"w{k}" for k in range(1 + i % 17)) + " ", "en", f"s{i % 3}", 5) for i in range(60)]
    docs += [(100, "\tlead in " + " ".join(["x"] * 40), "en", "s0", 1), (101, None, None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    made = mixing.mixed_documents(df).collect()
    words = {}
    for r in made:
        words[r.doc_id] = words.get(r.doc_id, 0) + len((r.text or "").split())
        whole = next(d[1] for d in docs if d[0] == r.doc_id)
        assert whole is None or whole.startswith(r.text)
        assert r.text == whole or r.n_chars == len(r.text)
    assert words == {r.doc_id: r.taken for r in mixing.mix(df).collect() if r.taken or r.size == 0 and r.whole_copies}


def test_rows_without_an_id_have_ranks_of_their_own(spark):
    """A source of null ids is sampled row by row, and only rows that repeat the text as well share a rank."""
    docs = [(None, f"w{i} " * (5 + i % 7), "en", "a" if i % 3 else "b", 5) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    rows = mixing.mix(df).collect()
    assert sum(r.taken % r.size > 0 for r in rows) <= 2 and len({r.taken // r.size for r in rows}) > 1
    made = mixing.mixed_documents(df, whole_only=True)
    words = {}
    for r in made.collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    for r in mixing.mix(df, carry={"source": "string"}).select("source", "target").distinct().collect():
        assert abs(words[r.source] - r.target) <= 6


def test_a_large_plan_is_joined_by_a_shuffle(spark):
    docs = [(i, " ".join(["w"] * (1 + i % 13)), "en", f"s{i % 9}" if i % 4 else None, 5) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    rows = [sorted(map(tuple, mixing.mixed_documents(df, whole_only=True, plan_bytes=b).collect()), key=repr) for b in (0, 1_000_000)]
    assert rows[0] == rows[1]


def test_texts_cross_no_shuffle(spark):
    df = spark.createDataFrame([(i, "w " * i, "en", f"s{i % 3}", 5) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = mixing.mixed_documents(df, whole_only=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
