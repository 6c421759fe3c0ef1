"""Statistics against pandas and NumPy, degenerate input, and invariants."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from skyledger import constants as C
from skyledger.operators import distributions, features, reporting, result_tables, trends, tuning
from skyledger.sources import readings as source, sampling


@pytest.fixture(scope="module")
def pdf(readings):
    return readings.toPandas()


def test_describe_equals_pandas(readings, pdf):
    got = distributions.describe(readings).toPandas().set_index("statistic").loc[distributions.STATISTICS]
    pd.testing.assert_frame_equal(got, pdf[C.POLLUTANTS].describe().round(2), check_names=False, atol=0.0101)


def test_correlations_equal_pandas(readings, pdf):
    got = trends.correlation_matrix(readings).toPandas().pivot(index="a", columns="b", values="corr")
    np.testing.assert_allclose(got.loc[C.POLLUTANTS, C.POLLUTANTS], pdf[C.POLLUTANTS].corr(), atol=1e-9)


def test_correlations_are_symmetric_with_ones_on_the_diagonal(readings):
    rows = {(r["a"], r["b"]): r["corr"] for r in trends.correlation_matrix(readings).collect()}
    assert len(rows) == len(C.POLLUTANTS) ** 2
    for (a, b), value in rows.items():
        assert value == rows[(b, a)]
        assert value == 1.0 if a == b else abs(value) <= 1 + 1e-12


def test_correlations_with_gaps_and_constants(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"a": rng.normal(1e6, 1e-3, 300), "b": rng.normal(size=300), "c": 0.1, "d": np.nan})
    data["b"] += (data["a"] - 1e6) * 500
    data.loc[::3, "a"] = np.nan
    data.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(data)
    rows = {(r["a"], r["b"]): r["corr"] for r in trends.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert rows[("a", "b")] == pytest.approx(data["a"].corr(data["b"]), abs=1e-6)
    assert all(rows[pair] is None for pair in [("a", "c"), ("c", "c"), ("a", "d"), ("d", "d"), ("b", "d")])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=80))
def test_exact_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["prob"]: r["value"] for r in distributions.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0], accuracy=8, task_rows=3).collect()}
    kept = [v for v in values if v is not None]
    if not kept:
        assert got == {}
    for p, value in got.items():
        assert value == pytest.approx(np.quantile(kept, p), rel=1e-9, abs=1e-9)


def test_exact_quantiles_with_one_value_in_a_third_of_the_rows(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    values = df.toPandas()["x"]
    got = {r["prob"]: r["value"] for r in distributions.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    assert got == {p: pytest.approx(np.quantile(values, p)) for p in (0.25, 0.5, 0.75)}


def test_approximate_quantiles_have_the_same_shape(readings):
    exact = {(r[0], r[1]): r[2] for r in distributions.exact_quantiles(readings, ["PM2_5", "NO2"], [0.25, 0.5]).collect()}
    approx = {(r[0], r[1]): r[2] for r in distributions.approx_quantiles(readings, ["PM2_5", "NO2"], [0.25, 0.5]).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) < 2 for k in exact)


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None)], "a double, b double")
    rows = {r["statistic"]: (r["a"], r["b"]) for r in distributions.describe(df, ["a", "b"]).collect()}
    assert set(rows) == set(distributions.STATISTICS)
    assert rows["count"] == (1.0, 0.0) and rows["50%"] == (1.0, None) and rows["std"] == (None, None)


def test_histogram_equals_numpy(readings, pdf):
    rows = distributions.histogram(readings, "AQI", 50).orderBy("bin").collect()
    counts, edges = np.histogram(pdf["AQI"].dropna(), 50)
    assert [r["n"] for r in rows] == counts.tolist()
    np.testing.assert_allclose([r["bin_low"] for r in rows], edges[:-1])
    assert sum(r["n"] for r in rows) == pdf["AQI"].notna().sum()


def test_histogram_of_a_constant_and_of_nothing(spark):
    constant = spark.createDataFrame([(5.0,)] * 4, "x double")
    rows = distributions.histogram(constant, "x", 10).orderBy("bin").collect()
    assert [r["n"] for r in rows] == np.histogram([5.0] * 4, 10)[0].tolist()
    assert distributions.histogram(constant.limit(0), "x", 10).count() == 0


def test_box_whiskers_stay_inside_the_fences(readings, pdf):
    for row in distributions.box_stats(readings).collect():
        values = pdf[row["column"]].dropna()
        reach = 1.5 * (row["q3"] - row["q1"])
        inside = values[(values >= row["q1"] - reach) & (values <= row["q3"] + reach)]
        assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())
        assert row["outliers"] == len(values) - len(inside)


def test_box_stats_count_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(10), 1000, 1000, -500]], "x double")
    row = distributions.box_stats(df, ["x"]).first()
    assert row["outliers"] == 3 and row["whisker_high"] == 9.0 and row["whisker_low"] == 0.0


def test_null_keys_are_dropped_by_analyses_and_kept_by_tables(spark, cleaned):
    df = spark.createDataFrame([("a", 1), (None, 3), ("a", 3)], "country string, AQI int")
    assert [tuple(r) for r in trends.mean_by(df, "country").collect()] == [("a", 2.0)]
    with_null = cleaned.limit(20).withColumn("hour", F.lit(None).cast("int"))
    assert [r["hour"] for r in result_tables.hourly_patterns(with_null).collect()] == [None]


def test_one_row_group_has_no_deviation(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 4)], "country string, AQI int")
    rows = {r["country"]: r["std"] for r in trends.mean_std_by(df, "country").collect()}
    assert rows["a"] is None and rows["b"] == pytest.approx(2 ** 0.5)


def test_reduction_needs_both_groups(spark):
    df = spark.createDataFrame([(0, 100), (1, 80)], "has_carbon_tax int, AQI int")
    assert trends.group_reduction(df).first()[0] == pytest.approx(20.0)
    assert trends.group_reduction(df.filter("has_carbon_tax = 0")).first()[0] is None


def test_extremes_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("d", 1), ("c", 1)], "country string, AQI int")
    row = trends.extreme_groups(df, "country").first()
    assert (row["highest"], row["lowest"]) == ("a", "c")


def test_scaled_values_lie_between_zero_and_one(readings, spark):
    rows = trends.health_by_country_normalized(readings).collect()
    for c in C.HEALTH_COLUMNS:
        values = [r[c] for r in rows]
        assert min(values) == 0.0 and max(values) == 1.0
    flat = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r["x"] for r in trends.minmax_scale(flat, ["x"]).collect()] == [None, None]
    assert [r["x"] for r in trends.standardize(flat, ["x"]).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("name", result_tables.RESULT_TABLES)
def test_counts_add_up_to_the_cleaned_rows(cleaned, name):
    table = result_tables.RESULT_TABLES[name](cleaned)
    count = "total_records" if name == "yearly_trends" else "record_count"
    assert table.agg(F.sum(count)).first()[0] == cleaned.count()


def test_trend_of_a_line(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 3).alias("AQI"))
    assert tuple(trends.linear_trend(df, "x").first()) == pytest.approx((2.0, 3.0, 0.0, 49.0))
    points = trends.trend_line(df, "x", n=5, low=0, high=8).orderBy("point").collect()
    assert [r["x"] for r in points] == pytest.approx([0, 2, 4, 6, 8])
    assert [r["y"] for r in points] == pytest.approx([3, 7, 11, 15, 19])


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "label double, prediction double")
    assert tuple(tuning.regression_metrics(df).first()) == (None, 0.5, 0.5)


def test_label_codes_number_null_as_its_own_value(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "z")], "record_id int, t string")
    rows = {r["record_id"]: r["code"] for r in features.encode_label(df, "t", "code").collect()}
    assert rows == {3: 0, 1: 1, 2: 2, 4: 3}


# --- samples --------------------------------------------------------------------

def _parts(spark):
    return (
        spark.range(6510)
        .select(
            F.when(F.col("id") < 10, "small").when(F.col("id") < 1510, "middle").otherwise("large").alias("part"),
            F.col("id").alias("record_id"),
            F.timestamp_add("HOUR", F.col("id") % 700, F.lit("2020-01-01").cast("timestamp_ntz")).alias("timestamp"),
        ).repartition(7)
    )


def _sizes(df):
    return {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}


def test_sample_sizes(spark):
    sample = sampling.sample_per_part(_parts(spark), "part", total=4500)
    assert _sizes(sample) == {"small": 10, "middle": 1500, "large": 1500}
    assert _sizes(sampling.sample_per_part(_parts(spark), "part", total=30)) == {"small": 10, "middle": 1000, "large": 1000}
    assert sample.select("record_id").distinct().count() == 3010


def test_sample_does_not_depend_on_the_partitioning(spark):
    ids = [set(sampling.sample_rows(_parts(spark).repartition(n), 100).toPandas()["record_id"]) for n in (1, 13)]
    assert ids[0] == ids[1] and len(ids[0]) == 100
    assert sampling.sample_rows(_parts(spark), 10**6).count() == 6510


def test_head_takes_the_earliest_rows(spark):
    pdf = _parts(spark).toPandas().sort_values(["timestamp", "record_id"])
    expected = pdf.groupby("part").head(55)
    got = sampling.head_per_part(_parts(spark), "part", n=55).toPandas()
    assert set(got["record_id"]) == set(expected["record_id"])


def test_samples_of_a_group_of_copies_stay_whole(spark):
    copies = spark.range(4000).select(F.lit("p").alias("part"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("record_id"),
                                      F.lit("2020-01-01").cast("timestamp_ntz").alias("timestamp"))
    assert sampling.head_per_part(copies, "part", n=1000).count() == 1000
    assert sampling.sample_rows(copies, 3000).count() == 3000


def test_head_keeps_missing_times_and_parts(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 2, "2020-01-01"), ("a", 3, None)], "part string, record_id int, t string")
    df = df.withColumn("timestamp", F.col("t").cast("timestamp_ntz"))
    assert {r["record_id"] for r in sampling.head_per_part(df, "part", n=1).collect()} == {1, 3}


def test_metadata_totals_match_the_overview(readings):
    overview = source.dataset_overview(readings).first()
    totals = {r["item"]: r["records"] for r in source.dataset_metadata(readings, "year").filter("section = 'total'").collect()}
    assert (totals["records"], totals["countries"], totals["stations"]) == (overview[0], overview[1], overview[3])


def test_best_model_and_cards(spark, cleaned):
    tuning_table = spark.createDataFrame([("A", 0.9), ("C", 0.97), ("B", 0.97)], "model_name string, test_r2 double")
    assert tuple(reporting.best_model(tuning_table).first()) == ("B", 0.97)
    cards = reporting.overview_cards(
        result_tables.country_aqi_stats(cleaned), result_tables.city_aqi_stats(cleaned), tuning_table).first()
    assert (cards["best_model"], cards["total_records"]) == ("B", cleaned.count())
    assert reporting.overview_cards(
        result_tables.country_aqi_stats(cleaned), result_tables.city_aqi_stats(cleaned)).first()["best_model"] is None


# --- cube and sketches ----------------------------------------------------------

def _same_numbers(left, right):
    """Equal rows, numbers to twelve digits or so."""
    assert set(left.columns) == set(right.columns)
    a, b = (sorted((tuple(r) for r in df.select(*sorted(left.columns)).collect()), key=lambda r: tuple((not isinstance(v, float), str(v)) for v in r if not isinstance(v, float)))
            for df in (left, right))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == tuple(pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v for v in y)


def test_cube_gives_the_result_tables(cleaned):
    from skyledger.operators import cube
    halves = [cube.table_cube(cleaned.where(F.pmod(F.xxhash64("record_id"), F.lit(2)) == i)) for i in (0, 1)]
    rows = cube.merge(halves).cache()
    for name in cube.TABLE_GROUPINGS:
        _same_numbers(cube.CUBE_TABLES[name](rows), result_tables.RESULT_TABLES[name](cleaned))


def test_cube_gives_the_analyses(readings):
    from skyledger.operators import cube
    from skyledger.plans.pipeline import ANALYSES
    odd = readings.withColumn("month", F.when(F.col("month") != 3, F.col("month"))).withColumn("PM2_5", F.when(F.col("hour") == 1, float("nan")).otherwise(F.col("PM2_5")))
    rows = cube.analysis_cube(odd).cache()
    for name in cube.ANALYSIS_GROUPINGS:
        _same_numbers(cube.CUBE_TABLES[name](rows), ANALYSES[name](odd))


def test_cube_scans_once(readings):
    from skyledger.operators import cube
    plan = cube.table_cube(readings.withColumn("aqi_bracket", F.lit("0-50")))._jdf.queryExecution().executedPlan().toString()
    once = readings.select("AQI", "country", "station_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= once.count("FileScan") and plan.count("Expand") == 1


def test_quantiles_and_boxes_read_twice(spark, readings):
    """One pass for the sketches and one for the hits, counted by the rows that leave the source."""
    rows = readings.select(*distributions.C.POLLUTANTS)
    total, seen = rows.count(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = rows.mapInArrow(counted, rows.schema)
    for job in (lambda: distributions.describe(source, digits=None).collect(), lambda: distributions.box_stats(source).collect()):
        before = seen.value
        job()
        assert seen.value - before <= 2 * total


def test_box_stats_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (2.0, None, 5.0), (None, None, 5.0), (float("nan"), None, 5.0), (100.0, None, 5.0)], "a double, b double, c double")
    rows = {r["column"]: tuple(r)[1:] for r in distributions.box_stats(df, ["a", "b", "c"]).collect()}
    assert rows == {"a": (1.5, 2.0, 51.0, 1.0, 100.0, 0), "c": (5.0, 5.0, 5.0, 5.0, 5.0, 0)}
    assert distributions.box_stats(df, ["b"]).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=80))
def test_box_stats_of_any_values(spark, values):
    row = distributions.box_stats(spark.createDataFrame([(v,) for v in values], "x double"), ["x"], accuracy=8, task_rows=3).first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    low, high = row["q1"] - 1.5 * (row["q3"] - row["q1"]), row["q3"] + 1.5 * (row["q3"] - row["q1"])
    inside = [v for v in values if low <= v <= high]
    assert (row["q1"], row["q3"]) == (pytest.approx(q1, rel=1e-9, abs=1e-9), pytest.approx(q3, rel=1e-9, abs=1e-9))
    assert row["outliers"] == len(values) - len(inside)
    assert (row["whisker_low"], row["whisker_high"]) == (min([row["q1"], *inside]), max([row["q3"], *inside]))


def test_new_parts_are_added_to_stored_sketches(spark, readings, tmp_path):
    from skyledger.sources import results, sketches
    stored = lambda: results.read_result_table(spark, str(tmp_path), sketches.SKETCHES, order=[]).drop("processed_at")
    years = [r["year"] for r in readings.select("year").distinct().collect()]
    first = readings.where(F.col("year") < 1995)
    assert sketches.store_sketches(first, "year", str(tmp_path)) == len([y for y in years if y < 1995])
    before = {r["part"]: bytes(r["hll_city"]) for r in stored().collect()}
    seen = spark.sparkContext.accumulator(0)
    assert sketches.store_sketches(readings, "year", str(tmp_path)) == len([y for y in years if y >= 1995])
    assert sketches.store_sketches(readings, "year", str(tmp_path)) == 0
    after = {r["part"]: bytes(r["hll_city"]) for r in stored().collect()}
    assert set(after) == {str(y) for y in years} and all(after[p] == s for p, s in before.items()) and seen.value == 0
    merged, once = (df.select(*[F.hll_sketch_estimate(f"hll_{k}").alias(k) for k in sketches.KEYS], "rows").first()
                    for df in (sketches.merged(stored()), sketches.merged(sketches.part_sketches(readings, "AQI_category"))))
    assert merged == once
    exact = readings.agg(*[F.countDistinct(k).alias(k) for k in sketches.KEYS]).first()
    assert all(abs(merged[k] - exact[k]) <= max(1, exact[k] * sketches.distinct_error()) for k in sketches.KEYS)
    profile = sketches.quantile_profile(stored())
    from_sketches, plain = ({(r[0], r[1]): r[2] for r in distributions.exact_quantiles(readings, ["PM2_5", "NO2"], [0.25, 0.9], profile=p).collect()}
                            for p in ({k: profile[k] for k in ("PM2_5", "NO2")}, None))
    assert from_sketches == plain
