"""What keeps the jobs in proportion to their input: cheap rounding, small sides of joins, bounded passes."""

import bisect
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from checks import queries
from skyledger.functions.hashing import row_hash
from skyledger.functions.numeric import half_up
from skyledger.operators import boosting, features, sinks, tuning
from skyledger.operators.tree_params import TreeParams
from skyledger.operators.trees import fit
from skyledger.plans import pipeline
from skyledger.schema import readings_schema
from skyledger.session import HOTSPOT_SETTINGS, with_settings
from skyledger.sources import readings as source, star


@pytest.mark.parametrize("digits", [4, 6, 8])
def test_quick_rounding_is_round(spark, digits):
    draw = random.Random(digits)
    ties = [(k + 0.5) / 10 ** digits for k in range(-300, 300)]
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 5e-324, -1e-300, 1e300, 2.0 ** 53, *ties, *[math.nextafter(t, math.inf) for t in ties],
              *[draw.uniform(-1, 1) * 10 ** draw.randint(-12, 18) for _ in range(5000)], *[draw.randint(-10 ** 9, 10 ** 9) / 200 for _ in range(2000)]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.select("v", (F.round("v", digits) + F.lit(0.0)).alias("a"), (half_up("v", digits) + F.lit(0.0)).alias("b")).collect()
    assert [r for r in rows if repr(r["a"]) != repr(r["b"])] == []


def test_readings_never_send_the_line_items_to_the_stations(spark, folder):
    """Stations are small by the size of their file, so the line items stay where they are read."""
    for columns in (["AQI"], ["station_id", "AQI", "city"]):
        plan = star.readings(spark, folder).select(*columns)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "BuildLeft" not in plan and "hashpartitioning" not in plan


def test_settings_leave_what_the_session_was_given(spark):
    key = next(iter(HOTSPOT_SETTINGS))
    given = spark.conf.get(key)
    try:
        spark.conf.set(key, "1234")
        assert with_settings(spark).conf.get(key) == "1234"
        spark.conf.unset(key)
        assert with_settings(spark).conf.get(key) == HOTSPOT_SETTINGS[key]
    finally:
        spark.conf.set(key, given)


def test_packed_csv_takes_a_part_of_the_room(spark, readings, tmp_path):
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / name).glob("part-*"))
    rows = readings.limit(1200).coalesce(1)
    for name, compression in (("plain", None), ("packed", "snappy")):
        sinks.write_readings(rows, str(tmp_path / name), max_rows=500, compression=compression)
    assert 1.6 * size("packed") < size("plain") and len(list((tmp_path / "packed").glob("part-*.csv.snappy"))) == 3
    back = [source.scan_readings(spark, str(tmp_path / name), schema=readings_schema(record_id=StringType())) for name in ("plain", "packed")]
    assert back[1].count() == 1200 and back[0].exceptAll(back[1]).isEmpty()


def test_the_scan_query_writes_packed_csv(spark, folder, monkeypatch):
    seen = []
    real = sinks.write_readings
    monkeypatch.setattr(sinks, "write_readings", lambda *a, **options: seen.append(options) or real(*a, **options))
    queries.QUERIES["scan_readings"](spark, folder).collect()
    assert seen == [{"compression": "snappy"}]


def _limits(values, bins):
    ordered = sorted(values)
    return sorted({ordered[math.ceil(i * len(ordered) / bins) - 1] for i in range(1, bins)})


def test_limits_are_exact_ranks_in_any_partitioning(spark):
    draw = random.Random(5)
    rows = [(draw.choice([None, math.nan, 0.5, 2.0, 7.0]), draw.gauss(0, 1), None) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    want = {"a": _limits([a for a, _, _ in rows if a is not None and a == a], 8), "b": _limits([b for _, b, _ in rows], 8), "c": []}
    assert boosting.bin_limits(df, ["a", "b", "c"], 8) == want == boosting.bin_limits(df.repartition(7), ["a", "b", "c"], 8)
    assert boosting.bin_limits(df.limit(0), ["a", "b"], 8) == {"a": [], "b": []}


def test_limits_of_many_values_keep_their_bound(spark, monkeypatch):
    """Chunks with more values than points send points only, and ranks are off by no more than a step."""
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 400)
    draw = random.Random(6)
    values = [draw.gauss(0, 1) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert boosting.summaries(df, ["v"], 100).agg(F.sum("n")).first()[0] == 20_000
    assert boosting.summaries(df, ["v"], 100).count() < 6000
    ordered, limits = sorted(values), boosting.bin_limits(df, ["v"], 16, 100)["v"]
    assert len(limits) == 15
    assert all(abs(bisect.bisect_right(ordered, x) / 20_000 - i / 16) <= 1 / 100 for i, x in enumerate(limits, 1))


def test_rows_with_the_same_bins_are_one_row_of_a_tree(spark):
    draw = random.Random(7)
    rows = [([draw.randint(0, 3), draw.randint(0, 2)], draw.gauss(0, 1), 1.0) for _ in range(2000)]
    df = spark.createDataFrame(rows, "bins array<int>, g double, h double")
    few = boosting.alike(df)
    assert few.count() == 12 and few.agg(F.sum("n")).first()[0] == 2000
    params = TreeParams(max_depth=3, min_samples_leaf=40, min_samples_split=90, learning_rate=0.1, reg_alpha=1.0, reg_lambda=2.0)
    a, b = boosting.grow(df, params), boosting.grow(few, params)
    assert all((getattr(a, n) == getattr(b, n)).all() for n in ("column", "cut", "left"))
    assert a.value == pytest.approx(b.value) and a.gain == pytest.approx(b.gain)


def test_sample_drops_the_other_rows_where_they_are_read(spark, monkeypatch):
    """The rows of the sample are those of a sort of the whole table, but only a bucket's worth more is sorted."""
    rows = spark.range(20_000).select(F.concat(F.lit("r"), "id").alias("record_id")).unionByName(spark.createDataFrame([(None,), (None,)], "record_id string"))
    hashed = row_hash("record_id", 43)
    for n in (0, 1, 700, 30_000):
        found = [r[0] for r in tuning._first_by_hash(rows, hashed, n).collect()]
        assert found == [r[0] for r in rows.orderBy(hashed, "record_id").limit(n).collect()]
    plan = tuning._first_by_hash(rows, hashed, 700)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan


def test_a_pipeline_reads_a_derived_table_once(spark, readings, tmp_path, monkeypatch):
    """Analyses read the stored readings, not what these are derived from; the log has no row for that copy."""
    seen, real = [], pipeline.cube.analysis_cube
    monkeypatch.setattr(pipeline, "ANALYSES", {"dow_aqi": pipeline.ANALYSES["dow_aqi"]})
    monkeypatch.setattr(pipeline, "CSV_REPORTS", ())
    monkeypatch.setattr(pipeline.cube, "analysis_cube", lambda r: seen.append(r) or real(r))
    entries = pipeline.run_pipeline(spark, readings, str(tmp_path), ["analysis"])
    assert seen[0].inputFiles() and all(str(tmp_path / "readings") in f for f in seen[0].inputFiles())
    assert "readings" not in {e["output_table"] for e in entries} and seen[0].exceptAll(readings).isEmpty()


@pytest.mark.parametrize("params", [TreeParams(max_depth=6), TreeParams(max_depth=None, bootstrap=True, node_columns=3)])
def test_rows_walk_to_the_leaf_of_their_bins(params):
    draw = np.random.default_rng(3)
    bins = draw.integers(0, 32, (1500, 7)).astype(np.uint8)
    y = bins[:, 0] * 2.0 + bins[:, 3] + draw.normal(0, 3, 1500)
    for tree in fit(bins, y, 32, params, 3, 11).trees:
        found = []
        for row in bins:
            node = 0
            while tree.column[node] >= 0:
                node = tree.left[node] + (row[tree.column[node]] > tree.cut[node])
            found.append(tree.value[node])
        assert (tree.predict(bins) == np.array(found)).all()
    assert len(tree.predict(bins[:0])) == 0


@pytest.mark.parametrize("depth", [0, 1, 4, 6, 7])
def test_masks_and_steps_find_the_same_leaf(depth, monkeypatch):
    """Trees of up to 64 leaves are read off tables by column and bin; larger ones, and other types of bins, walk."""
    draw = np.random.default_rng(depth)
    bins = draw.integers(0, 32, (3000, 9)).astype(np.uint8)
    y = bins[:, 0] * 2.0 + bins[:, 3] * bins[:, 4] + draw.normal(0, 3, 3000)
    ensemble = fit(bins, y, 32, TreeParams(max_depth=depth, learning_rate=0.1), 4, 11)
    others = draw.integers(0, 256, (500, 9)).astype(np.uint8)
    for tree in ensemble.trees:
        walks, real = [], tree._walked
        monkeypatch.setattr(tree, "_walked", lambda b: walks.append(1) or real(b))
        for rows in (bins, others, others[:0], np.asfortranarray(others)):
            assert (tree.predict(rows) == real(rows)).all() and len(tree.predict(rows)) == len(rows)
        assert bool(walks) == (np.count_nonzero(tree.column < 0) > 64)
        assert (tree.predict(others.astype(np.int64)) == real(others)).all()


def test_features_are_computed_once_a_row(spark):
    """The test for complete rows does not repeat what the columns are derived from, and drops null and NaN alike."""
    rows = spark.createDataFrame([("a", 4.0, 1), ("b", None, 2), ("c", math.nan, 3), ("d", 9.0, None), (None, 16.0, 5)], "record_id string, x double, y int")
    found = features.ml_features(rows.select("record_id", F.sqrt("x").alias("PM2_5"), F.col("y").alias("AQI")))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("SQRT") == 1
    assert found.dtypes == [("record_id", "string"), ("PM2_5", "double"), ("AQI", "double")]
    assert sorted(found.collect(), key=str) == [("a", 2.0, 1.0), (None, 4.0, 5.0)]


def test_searches_read_the_split_instead_of_hashing(spark, folder):
    """Parts of the stored features are those of the split by hash."""
    stored = queries.split_features(spark, folder)
    whole = features.ml_features(star.readings(spark, folder))
    for part, expected in zip(stored, features.train_test_split(whole)):
        assert "md5" not in part._jdf.queryExecution().optimizedPlan().toString()
        assert part.columns == expected.columns and part.exceptAll(expected).isEmpty() and expected.exceptAll(part).isEmpty()


def test_the_filter_of_a_sample_hashes_an_id_once(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("record_id"))
    plan = tuning._first_by_hash(rows, row_hash("record_id", 43), 50)._jdf.queryExecution().optimizedPlan().toString()
    assert [line.count("md5") for line in plan.splitlines() if "Filter" in line] == [1]
