"""Clusters and principal components of city pollution profiles."""

import math

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger import constants as C
from skyledger.functions.hashing import row_hash
from skyledger.operators.trends import mean_by, standardize

LLOYD_STEPS = 25


def city_profiles(r: DataFrame, key: str = "city", columns=tuple(C.PROFILE_COLUMNS)) -> DataFrame:
    """Mean of each profile column per city; cities without a value in some column are left out."""
    return mean_by(r, key, {c: c for c in columns}).dropna()


def scale_profiles(profiles: DataFrame, columns=tuple(C.PROFILE_COLUMNS)) -> DataFrame:
    return standardize(profiles, list(columns))


def _vectors(scaled: DataFrame, columns) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(scaled)


def _near(v: Column, centres: Column) -> Column:
    """(d, i): squared distance and number of the nearest centre, the first of several."""
    def far(centre: Column) -> Column:
        return F.aggregate(F.zip_with(v, centre, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, d: total + d)
    return F.array_min(F.transform(centres, lambda centre, i: F.struct(far(centre).alias("d"), i.alias("i"))))


def _dealt(points: DataFrame, runs: list[list[list[float]]]) -> DataFrame:
    """Every point once per run, with its nearest centre there; the runs' centres are a table of one row each."""
    table = points.sparkSession.createDataFrame([(n, centres) for n, centres in enumerate(runs)], "run int, centres array<array<double>>")
    number = F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1)))
    return points.withColumn("run", number).join(F.broadcast(table), "run").withColumn("near", _near(F.col("v"), F.col("centres")))


def _first_centres(points: DataFrame, k: int, restarts: int) -> list[list[list[float]]]:
    """Per restart ``k`` points: one by hash of the key, then always the one farthest from those before (ties by hash and key)."""
    chosen = [[list(row["v"])] for row in points.orderBy("hash", "key").limit(restarts).collect()]
    while chosen and len(chosen[0]) < k:
        farthest = F.max_by("v", F.struct(F.col("near.d"), F.col("hash"), F.col("key"))).alias("v")
        for row in _dealt(points, chosen).groupBy("run").agg(farthest).collect():
            chosen[row["run"]].append(list(row["v"]))
    return chosen


def city_clusters(scaled: DataFrame, k: int = 4, restarts: int = 10, seed: int = 42, key: str = "city",
                  columns=tuple(C.PROFILE_COLUMNS), steps: int = LLOYD_STEPS) -> DataFrame:
    """(key, cluster): the cheapest of ``restarts`` runs of Lloyd's steps on standardised profiles.

    All runs go on together: a step joins the rows to the runs' centres and
    aggregates them, by nearest centre of each run, into the next centres. The
    driver holds k rows per run and nothing else; the profiles (one row per city)
    are kept in memory only while the steps go on. Starts follow from a hash of
    the key, so a rerun gives the same clusters in any partitioning; a cluster
    that loses all its rows keeps its centre. Runs end when no centre moves, or
    after ``steps`` steps.
    """
    columns = list(columns)
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    points = scaled.select(F.col(key).alias("key"), row_hash(key, seed).alias("hash"), vector.alias("v")).persist()
    try:
        runs = _first_centres(points, k, restarts)
        if not runs:
            return scaled.select(key, F.lit(None).cast("int").alias("cluster"))
        cost = [0.0] * len(runs)
        for _ in range(steps):
            means = F.array(*[F.avg(F.col("v")[i]) for i in range(len(columns))])
            rows = _dealt(points, runs).groupBy("run", F.col("near.i").alias("cluster")).agg(means.alias("v"), F.sum("near.d").alias("cost")).collect()
            moved, cost = [list(centres) for centres in runs], [0.0] * len(runs)
            for row in rows:
                moved[row["run"]][row["cluster"]] = list(row["v"])
                cost[row["run"]] += row["cost"]
            last, runs = runs, moved
            if all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(last, runs) for p, q in zip(x, y) for a, b in zip(p, q)):
                break
    finally:
        points.unpersist()
    # the centres that the costs belong to
    best = min(range(len(last)), key=lambda n: (round(cost[n], 9), n))
    centres = F.array(*[F.array(*map(F.lit, centre)) for centre in last[best]])
    return scaled.select(key, _near(vector, centres)["i"].alias("cluster"))


def city_pca(scaled: DataFrame, key: str = "city", columns=tuple(C.PROFILE_COLUMNS)) -> DataFrame:
    """Coordinates on the first two components and the share of variance each explains.

    The input must be centred, as ``scale_profiles`` leaves it. A component's
    sign is that which makes its largest loading positive (the first of several
    as large), so the same profiles have the same coordinates everywhere.
    """
    vectors = _vectors(scaled, columns)
    model = PCA(k=2, inputCol="features", outputCol="pca").fit(vectors)
    first, second = (float(v) for v in model.explainedVariance.toArray())
    point = vector_to_array("pca")
    signs = []
    for loadings in model.pc.toArray().T:
        largest = max(range(len(loadings)), key=lambda i: (round(abs(loadings[i]), 9), -i))
        signs.append(1.0 if loadings[largest] >= 0 else -1.0)
    return model.transform(vectors).select(
        key, (point[0] * signs[0]).alias("pc1"), (point[1] * signs[1]).alias("pc2"),
        F.lit(first).alias("pc1_share"), F.lit(second).alias("pc2_share"),
    )


def city_cluster_table(profiles: DataFrame, clusters: DataFrame, components: DataFrame, key: str = "city") -> DataFrame:
    """Profiles with cluster and coordinates: the table behind the cluster chart."""
    return profiles.join(clusters, key).join(components.select(key, "pc1", "pc2"), key)


def cluster_examples(clusters: DataFrame, n: int = 5, key: str = "city") -> DataFrame:
    """Up to ``n`` cities of each cluster in alphabetical order."""
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(key))
    return clusters.withColumn("place", place).filter(F.col("place") <= n)
