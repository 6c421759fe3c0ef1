"""Mergeable sketches per part of the readings: a new part is read, the old ones are not.

Per part: the number of rows, an HLL sketch of each key column for distinct
counts, and a KLL sketch of each value column for quantiles. Sketches of parts
merge into that of all readings without loss beside that of one pass.
"""

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import constants as C
from skyledger.functions.numeric import nan_to_null
from skyledger.operators import sinks
from skyledger.sources import results

KEYS = ("country", "city", "station_id")
HLL_BITS, KLL_SIZE = 14, 4_000
SKETCHES = "part_sketches"


def distinct_error(bits: int = HLL_BITS) -> float:
    """Relative error that a distinct count stays within in 997 of 1000 cases: three times 0.83 / sqrt(2^bits)."""
    return 3 * 0.83 / 2 ** (bits / 2)


def part_sketches(r: DataFrame, part: str, keys=KEYS, columns=tuple(C.POLLUTANTS)) -> DataFrame:
    """One row per part, combined map-side; sketches have a bounded size whatever a part holds."""
    values = {c: nan_to_null(F.col(c).cast("double")) for c in columns}
    return r.groupBy(F.col(part).cast("string").alias("part")).agg(
        F.count("*").alias("rows"), *[F.hll_sketch_agg(F.col(k).cast("string"), F.lit(HLL_BITS)).alias(f"hll_{k}") for k in keys],
        *[F.count(v).alias(f"count_{c}") for c, v in values.items()],
        *[F.kll_sketch_agg_double(v, F.lit(KLL_SIZE)).alias(f"kll_{c}") for c, v in values.items()])


def store_sketches(r: DataFrame, part: str, base: str, **columns) -> int:
    """Add the parts that the stored table lacks; returns how many these are. Only their rows are read where ``part`` partitions the files."""
    spark = r.sparkSession
    old = results.read_result_table(spark, base, SKETCHES, order=[], missing_schema="part string").drop("processed_at")
    known = [row["part"] for row in old.select("part").collect()]
    absent = F.coalesce(F.col(part).cast("string"), F.lit("")).isin([k or "" for k in known]) if known else F.lit(False)
    new = part_sketches(r.where(~absent), part, **columns)
    rows = new if not known else old.unionByName(new)
    return sinks.write_result(rows, SKETCHES, base, []) - len(known)


def merged(sketches: DataFrame) -> DataFrame:
    """The sketches of all parts as one row."""
    names = sketches.columns
    return sketches.agg(
        F.sum("rows").alias("rows"), *[F.hll_union_agg(c).alias(c) for c in names if c.startswith("hll_")], *[F.sum(c).alias(c) for c in names if c.startswith("count_")],
        *[F.kll_merge_agg_double(c, F.lit(KLL_SIZE)).alias(c) for c in names if c.startswith("kll_")])


def approximate_overview(sketches: DataFrame) -> DataFrame:
    """Rows, distinct keys and medians of all parts from their sketches alone."""
    one = merged(sketches)
    distinct = [F.hll_sketch_estimate(c).alias(f"{c.removeprefix('hll_')}_count") for c in one.columns if c.startswith("hll_")]
    return one.select(F.col("rows").alias("total_records"), *distinct, *[_median(c).alias(f"median_{c.removeprefix('kll_')}") for c in one.columns if c.startswith("kll_")])


def _median(sketch: str) -> Column:
    return F.when(F.col(sketch.replace("kll_", "count_", 1)) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)))


def quantile_profile(sketches: DataFrame) -> dict:
    """What ``exact_quantiles`` needs of a first pass, from stored sketches: count and sketch of every column."""
    row = merged(sketches).first()
    return {c.removeprefix("kll_"): {"count": row[c.replace("kll_", "count_", 1)], "sketch": row[c]} for c in row.asDict() if c.startswith("kll_")}
