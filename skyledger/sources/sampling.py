"""Samples of fixed size: exact, repeatable, and safe for a part that holds most rows.

"The k smallest rows of a group" would by itself sort the whole group in one
task. Here a coarse bucket that rises with the order column is counted first
(map-side); the bucket in which the k-th row falls is the cut, and only rows up
to it go on. What is left is ranked in two rounds, the first one spread over
input partitions, so that even a cut bucket full of copies is split.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.functions.hashing import row_hash

HASH_BUCKET_DIGITS = 4


def smallest_per_group(df: DataFrame, group: list[str], bucket: Column, order: list[str], n: int) -> DataFrame:
    """The ``n`` first rows of each group by ``order``; all of a smaller group.

    ``bucket`` must never fall while ``order`` rises. As ``n`` is a literal,
    Spark keeps no more than ``n`` rows per group while it sorts.
    """
    tagged = df.withColumn("_bucket", bucket)
    counts = tagged.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*group).orderBy("_bucket")
    cuts = (
        counts.withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
        .filter(F.col("_before") < n).groupBy(*group).agg(F.max("_bucket").alias("_cut"))
    )
    if group:
        renamed = cuts.withColumnsRenamed({k: f"_cut_{k}" for k in group})
        tagged = tagged.join(renamed, [F.col(k).eqNullSafe(F.col(f"_cut_{k}")) for k in group])
    else:
        tagged = tagged.withColumn("_cut", cuts.select("_cut").scalar())
    ranked = tagged.filter(F.col("_bucket").isNull() | (F.col("_bucket") <= F.col("_cut")))
    lanes = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = ranked.withColumn("_lane", F.spark_partition_id() % lanes)
    for partition in (group + ["_lane"], group):
        window = Window.partitionBy(*partition).orderBy(*order)
        ranked = ranked.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n)
    return ranked.select(*df.columns)


def sample_per_part(r: DataFrame, part_col: str, total: int = 500_000, seed: int = 42, floor: int = 1000,
                    id_col: str = "record_id") -> DataFrame:
    """Random rows of every part without replacement: ``max(floor, total / parts)`` of each.

    The number of parts is one small job over that column alone.
    """
    parts = r.select(part_col).distinct().count()
    hashed = r.withColumn("_hash", row_hash(id_col, seed))
    picked = smallest_per_group(hashed, [part_col], _hash_bucket(), ["_hash", id_col], max(floor, total // max(parts, 1)))
    return picked.select(*r.columns)


def head_per_part(r: DataFrame, part_col: str, order_col: str = "timestamp", n: int = 50_000,
                  id_col: str = "record_id") -> DataFrame:
    """The first ``n`` rows of every part by time, ties by id; NULL times first."""
    return smallest_per_group(r, [part_col], F.to_date(order_col), [order_col, id_col], n)


def sample_rows(r: DataFrame, k: int = 5000, seed: int = 42, id_col: str = "record_id") -> DataFrame:
    """``k`` random rows of the whole table, or all of a smaller one."""
    hashed = r.withColumn("_hash", row_hash(id_col, seed))
    return smallest_per_group(hashed, [], _hash_bucket(), ["_hash", id_col], k).select(*r.columns)


def _hash_bucket() -> Column:
    return F.substring("_hash", 1, HASH_BUCKET_DIGITS)
