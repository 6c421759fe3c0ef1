"""Tuning, clusters and components."""

from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators import clusters, features, reporting, sinks, tuning
from skyledger.operators.tree_params import TreeParams
from skyledger.operators.trees import fit


@pytest.fixture(scope="module")
def split(spark, readings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "rows")
    sinks.write_readings(features.ml_features(readings), path, "parquet")
    return features.train_test_split(spark.read.parquet(path))


def test_grid_sizes():
    assert tuning.grid_size(tuning.FOREST_GRID) == 216
    assert tuning.grid_size(tuning.BOOSTING_GRID) == 96
    assert tuning.grid_size(tuning.REGULARIZED_GRID) == 3888


def test_sampled_points_differ_and_repeat():
    points = tuning.sample_grid(tuning.REGULARIZED_GRID, 20)
    assert points == tuning.sample_grid(tuning.REGULARIZED_GRID, 20)
    assert len({tuple(p.items()) for p in points}) == 20
    assert len(tuning.sample_grid({"a": [1, 2]}, 20)) == 2


def test_features(split):
    train, _ = split
    assert len(features.feature_names(train)) == 28


def test_absent_columns_are_skipped(readings):
    few = features.ml_features(readings.select("record_id", "PM2_5", "AQI"))
    assert few.columns == ["record_id", "PM2_5", "AQI"]


def test_split_is_stable_and_about_one_fifth(split, readings):
    train, test = split
    share = test.count() / (train.count() + test.count())
    assert 0.17 < share < 0.23
    again = features.train_test_split(features.ml_features(readings.repartition(5)))[1]
    assert set(r[0] for r in again.select("record_id").collect()) == set(r[0] for r in test.select("record_id").collect())
    sample = tuning.fit_sample(train, 3, 42)
    assert len(sample.y) == train.count() and set(sample.fold) == {0, 1, 2}


@pytest.mark.parametrize("tune, points", [
    (tuning.tune_random_forest, 20), (tuning.tune_gradient_boosting, 15), (tuning.tune_boosted_regularized, 20)])
def test_full_search_beats_the_mean(spark, split, tune, points, floor=0.9):
    search, table = tune(*split)
    row = table.first()
    assert row["test_r2"] > floor and row["test_rmse"] >= row["test_mae"] > 0
    assert row["train_size"] == split[0].count() and row["feature_count"] == 28
    assert len(search.scores) == len(search.points) == points and search.cv_score == max(search.scores)
    assert search.params == search.points[search.scores.index(search.cv_score)]
    shares = tuning.feature_importance(spark, search.model, 28).collect()
    assert sum(r["importance"] for r in shares) == pytest.approx(1) and shares[0]["importance"] == max(r["importance"] for r in shares)
    assert len(tuning.feature_importance(spark, search.model).collect()) == 15


def test_sample_is_bounded_and_the_same_in_any_partitioning(split):
    a, b = (tuning.fit_sample(rows, 3, 42, fit_rows=500) for rows in (split[0], split[0].repartition(13)))
    assert len(a.y) == 500 and (a.bins == b.bins).all() and (a.y == b.y).all() and np.bincount(a.fold).min() > 100


def test_points_that_differ_in_the_number_of_trees_are_one_task(spark, split, monkeypatch):
    """Their scores are those of fits of their own."""
    seen = []
    real = tuning._staged_scores
    monkeypatch.setattr(tuning, "_staged_scores", lambda spark, shared, models, *rest: seen.extend(models) or real(spark, shared, models, *rest))
    grid = {"n_estimators": [3, 7], "max_depth": [3], "learning_rate": [0.3], "subsample": [0.8]}
    both = tuning.random_search(split[0], grid, 2, 2, fit_rows=800)
    assert [stages for _, stages in seen] == [[3, 7]]
    for point, score in zip(both.points, both.scores):
        alone = tuning.random_search(split[0], {k: [v] for k, v in point.items()}, 1, 2, fit_rows=800)
        assert alone.scores == [score]


def test_model_predicts_alike_in_spark_and_numpy(split):
    search = tuning.random_search(split[0], {"n_estimators": [5], "max_depth": [4]}, 1, 2, fit_rows=1000, bootstrap=True)
    rows = search.model.transform(split[1]).toPandas()
    expected = search.model.ensemble.predict(tuning._binned([rows[c] for c in search.model.limits], list(search.model.limits.values())))
    assert np.allclose(rows["prediction"], expected)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "label double, prediction double")
    y, p = np.array([1, 2, 4]), np.array([1.5, 2, 3])
    expected = (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), np.sqrt(((y - p) ** 2).mean()), np.abs(y - p).mean())
    assert tuple(tuning.regression_metrics(df, digits=None).first()) == pytest.approx(expected)


def test_comparison_marks_one_model(spark):
    rows = [spark.createDataFrame([(n, "{}", 0.9, r2, 1.0, 1.0, 1.0, 2, 10, 2)], tuning.TUNING_SCHEMA) for n, r2 in (("A", 0.8), ("B", 0.9))]
    assert {r["model_name"]: r["is_best"] for r in tuning.model_comparison(rows).collect()} == {"A": False, "B": True}


@pytest.mark.parametrize("scores, best", [
    ({"A": 0.9, "B": 0.9}, "A"), ({"C": None, "B": 0.9, "A": 0.9}, "A"), ({"A": None, "B": -0.5}, "B"), ({"A": None}, None)])
def test_one_winner_everywhere(spark, scores, best):
    """The first name wins a tie, a model without r2 never wins, and all reports name the same one."""
    rows = [spark.createDataFrame([(n, "{}", 0.9, r2, 1.0, 1.0, 1.0, 2, 10, 2)], tuning.TUNING_SCHEMA) for n, r2 in scores.items()]
    marked = [r["model_name"] for r in tuning.model_comparison(rows).filter("is_best").collect()]
    table = reduce(lambda a, b: a.union(b), rows)
    assert marked == ([best] if best else [])
    assert tuple(reporting.best_model(table).first()) == (best, scores.get(best))
    if best:
        assert reporting.model_ranking(table).filter("position = 1").first()["model_name"] == best


def test_clusters_and_components(readings):
    profiles = clusters.city_profiles(readings)
    scaled = clusters.scale_profiles(profiles)
    found = clusters.city_clusters(scaled, restarts=3)
    sizes = [r["count"] for r in found.groupBy("cluster").count().collect()]
    assert len(sizes) == 4 and sum(sizes) == profiles.count()
    assert clusters.cluster_examples(found, 1).count() == 4
    points = clusters.city_pca(scaled)
    row = points.first()
    assert 0 < row["pc2_share"] <= row["pc1_share"] and row["pc1_share"] + row["pc2_share"] <= 1 + 1e-9
    means = points.agg(F.avg("pc1"), F.avg("pc2")).first()
    assert all(abs(m) < 1e-9 for m in means)
    table = clusters.city_cluster_table(profiles, found, points)
    assert table.count() == profiles.count() and {"cluster", "pc1", "pc2"} <= set(table.columns)


@pytest.fixture(scope="module")
def many(spark):
    """More rows than a task holds as one array."""
    return spark.range(0, 25_000, 1, 7).select(
        F.concat(F.lit("r"), "id").alias("record_id"), (F.xxhash64("id") % 40).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        ((F.xxhash64("id") % 40) * 3 + F.pow(F.col("id") % 5, F.lit(2))).cast("double").alias("AQI"))


def test_every_training_row_is_fitted(many):
    a, b = (tuning.fit_sample(rows, 3, 42) for rows in (many, many.repartition(13)))
    assert len(a.y) == 25_000 and (a.bins == b.bins).all() and (a.y == b.y).all() and (a.fold == b.fold).all()
    first = tuning.fit_sample(many, 3, 42, fit_rows=300)
    assert (first.y == a.y[:300]).all() and (first.bins == a.bins[:300]).all()


@pytest.mark.parametrize("tune, point", [
    (tuning.tune_random_forest, {"n_estimators": 3, "max_depth": 6, "min_samples_leaf": 2}),
    (tuning.tune_gradient_boosting, {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.8}),
    (tuning.tune_boosted_regularized, {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "reg_alpha": 1.0, "reg_lambda": 2.0})])
def test_searches_learn_from_all_rows(spark, many, tune, point):
    """Models, scores and importances are those of fits over every training row."""
    search, _ = tune(many, many, {k: [v] for k, v in point.items()}, 1)
    assert search.model.ensemble.base == pytest.approx(many.agg(F.avg("AQI")).first()[0], rel=1e-9)
    rows, params = tuning.fit_sample(many, 3, 42), TreeParams.of_point(point, 2, tune is tuning.tune_random_forest)
    expected = fit(rows.bins, rows.y, 32, params, point["n_estimators"], 42)
    assert np.allclose(search.model.ensemble.predict(rows.bins), expected.predict(rows.bins))
    held = [rows.fold == f for f in range(3)]
    parts = [fit(rows.bins[~h], rows.y[~h], 32, params, point["n_estimators"], 42).predict(rows.bins[h]) for h in held]
    assert search.scores == [pytest.approx(np.mean([tuning.r2_score(rows.y[h], p) for h, p in zip(held, parts)]))]
    found = {r["feature"]: r["importance"] for r in tuning.feature_importance(spark, search.model).collect()}
    assert found == pytest.approx(dict(zip(rows.limits, expected.gains(2))))
