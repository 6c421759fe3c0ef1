"""Writers: result tables, readings, log, reports, and the checks on what was written."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from skyledger import constants as C
from skyledger.sources import storage
from skyledger.sources.results import POINTERS, VERSION, table_path, versions

LOG_TABLE = "processing_log"
LOG_SCHEMA = (
    "id long, stage string, records_processed long, duration_seconds double, output_table string, "
    "spark_version string, processed_at timestamp"
)
TUNING_TABLE = "model_tuning_results"
TUNING_SCHEMA = (
    "model_name string, best_params string, cv_score double, test_r2 double, test_rmse double, test_mae double, "
    "duration_seconds double, feature_count int, train_size long, test_size long"
)
ROWS_PER_FILE = 2_000_000
# a compressed CSV part is read by one task
ROWS_PER_PACKED_FILE = 500_000


class DuplicateKeyError(ValueError):
    """A result table holds two rows with the same primary key."""


def assert_unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The violations: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def write_result(df: DataFrame, name: str, base: str, keys: list[str] | None = None, stamp: str = "processed_at") -> int:
    """Replace a result table, stamped with the time; returns the number of rows.

    The executors write a version of its own and count its rows on the way out;
    the primary key is checked there. Only then the pointer is set, in one step
    that needs no rename: until it is there readers keep the old version, and a
    write that ends before leaves the table as it was. The version before stays
    for readers that have begun; older ones, and what broken writes left, go.
    """
    spark, seen, path = df.sparkSession, Observation(), table_path(base, name)
    known = versions(spark, path)
    version = f"{int(known[-1][:10]) + 1 if known else 1:010d}-{uuid.uuid4().hex[:8]}"
    stamped = df.withColumn(stamp, F.current_timestamp()).observe(seen, F.count("*").alias("rows"))
    stamped.write.parquet(f"{path}/{version}")
    keys = C.RESULT_KEYS.get(name) if keys is None else keys
    if keys:
        duplicates = assert_unique_keys(spark.read.parquet(f"{path}/{version}"), keys).limit(1).collect()
        if duplicates:
            storage.remove(spark, path if not known else f"{path}/{version}")
            raise DuplicateKeyError(f"{name}: more than one row for {duplicates[0].asDict()}")
    storage.mark(spark, f"{path}/{POINTERS}/{version}")
    drop_versions(spark, path)
    return seen.get["rows"]


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the last versions, pointers first, and what unfinished writes before them left."""
    known = versions(spark, path)
    kept = known[-keep:]
    for version in known[:-keep]:
        storage.remove(spark, f"{path}/{POINTERS}/{version}")
    for name in storage.names(spark, path):
        if VERSION.fullmatch(name) and name not in kept and name[:10] <= kept[-1][:10]:
            storage.remove(spark, f"{path}/{name}")


def write_readings(r: DataFrame, path: str, fmt: str = "csv", max_rows: int | None = None,
                   partition_by: list[str] | None = None, mode: str = "overwrite", compression: str | None = None) -> int:
    """Readings as CSV parts with a header, or as Parquet; at most ``max_rows`` rows per file.

    ``compression`` is one of Spark's for the format, such as ``snappy``, which halves the room of plain CSV and takes no longer.
    """
    seen = Observation()
    max_rows = max_rows or (ROWS_PER_PACKED_FILE if fmt == "csv" and compression else ROWS_PER_FILE)
    writer = r.observe(seen, F.count("*").alias("rows")).write.mode(mode).option("maxRecordsPerFile", max_rows)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"fmt must be 'csv' or 'parquet', not {fmt!r}")
    return seen.get["rows"]


def append_log(spark: SparkSession, entries: list[dict] | dict, base: str) -> None:
    """Append log rows (stage, records_processed, duration_seconds, output_table) in one write.

    Ids are microseconds of the log time, so appends need not read the log first.
    """
    entries = [entries] if isinstance(entries, dict) else entries
    rows = [Row(seq=i, stage=e["stage"], records=int(e["records_processed"]),
                seconds=round(float(e["duration_seconds"]), 2), table=e.get("output_table", "N/A"))
            for i, e in enumerate(entries)]
    df = spark.createDataFrame(rows, "seq long, stage string, records long, seconds double, table string")
    now = F.current_timestamp()
    df.coalesce(1).select(
        (F.unix_micros(now) + F.col("seq")).alias("id"), "stage", F.col("records").alias("records_processed"),
        F.col("seconds").alias("duration_seconds"), F.col("table").alias("output_table"),
        F.lit(spark.version).alias("spark_version"), now.alias("processed_at"),
    ).write.mode("append").parquet(table_path(base, LOG_TABLE))


def result_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every result table by name."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, counts)


def write_csv_report(df: DataFrame, path: str) -> None:
    """A small report (one row per statistic or group) as a single CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_tuning_results(df: DataFrame, base: str) -> int:
    """Replace the tuning table; ``best_params`` may be a map, which is stored as JSON."""
    if dict(df.dtypes)["best_params"] != "string":
        df = df.withColumn("best_params", F.to_json("best_params"))
    return write_result(df, TUNING_TABLE, base, stamp="tuned_at")
