"""Scan of the readings files and profiles of the loaded table."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from skyledger.schema import READINGS_SCHEMA

PART_COLUMN = "source_file"


def scan_readings(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                  schema: StructType = READINGS_SCHEMA, with_source_file: bool = False) -> DataFrame:
    """All parts under ``path`` (file, folder, glob or list) as one table.

    The schema is declared, so no pass is spent on inference; a CSV field that
    does not fit its type becomes NULL. Nothing is cached: a Parquet scan
    reads only the columns a query asks for.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    elif fmt != "parquet":
        raise ValueError(f"fmt must be 'csv' or 'parquet', not {fmt!r}")
    df = reader.format(fmt).load(path)
    return df.withColumn(PART_COLUMN, F.col("_metadata.file_path")) if with_source_file else df


def scan_profile(r: DataFrame) -> DataFrame:
    """Rows, columns and non-empty partitions, combined map-side."""
    per_partition = r.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))
    return per_partition.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(r.columns)).alias("column_count"),
        F.count("*").alias("partition_count"),
    )


def parse_time_columns(r: DataFrame, timestamp: str = "timestamp", date: str = "date") -> DataFrame:
    """Timestamp and date parsed from text; text that is no time becomes NULL."""
    return r.withColumns({
        timestamp: F.col(timestamp).cast("string").try_cast("timestamp_ntz"),
        date: F.col(date).cast("string").try_cast("date"),
    })


def dataset_overview(r: DataFrame) -> DataFrame:
    """Records, distinct countries, cities and stations, first and last date.

    Readings are first reduced to one row per station, so the distinct counts
    see the stations and not the readings.
    """
    stations = r.groupBy("country", "city", "station_id").agg(
        F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    return stations.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.countDistinct("country").alias("countries"),
        F.countDistinct("city").alias("cities"),
        F.countDistinct("station_id").alias("stations"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
    )


def dataset_metadata(r: DataFrame, part_col: str, examples: int = 5) -> DataFrame:
    """The dataset description as (section, item, records, detail) rows.

    Sections: ``total`` (records, columns, countries, cities, stations, start,
    end), ``country``, ``city``, ``sector`` and ``part`` with their record counts,
    ``station`` with the first ``examples`` stations of the alphabet, and
    ``column`` with the position and type of each column. Readings are reduced
    once to one row per station, sector and part; everything else is grouped
    from there, and no list is gathered into a single row.
    """
    sector = F.col("dominant_industry_sector").alias("sector")
    base = r.groupBy("country", "city", "station_id", sector, F.col(part_col).cast("string").alias("part")).agg(
        F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    names = ["country", "city", "sector", "part"]
    sections = [F.col(c) for c in names]
    counted = base.groupingSets([[c] for c in sections], *sections).agg(
        F.sum("n").alias("records"), *[F.grouping(c).alias(f"without_{c}") for c in names]
    )
    section = F.coalesce(*[F.when(F.col(f"without_{c}") == 0, F.lit(c)) for c in names])
    item = F.coalesce(*[F.when(F.col(f"without_{c}") == 0, F.col(c)) for c in names])
    none = F.lit(None).cast("string").alias("detail")
    items = counted.select(section.alias("section"), item.alias("item"), "records", none).filter(F.col("item").isNotNull())
    stations = base.filter("station_id IS NOT NULL").groupBy("station_id").agg(F.sum("n").alias("records"))
    first = stations.orderBy("station_id").limit(examples).select(F.lit("station").alias("section"), F.col("station_id").alias("item"), "records", none)
    columns = r.sparkSession.createDataFrame(
        [("column", f.name, i, f.dataType.simpleString()) for i, f in enumerate(r.schema, start=1)],
        "section string, item string, records long, detail string")
    one_row = base.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.countDistinct("country").alias("countries"),
        F.countDistinct("city").alias("cities"),
        F.countDistinct("station_id").alias("stations"),
        F.min("first").cast("string").alias("start"),
        F.max("last").cast("string").alias("end"),
    ).withColumn("columns", F.lit(len(r.columns)).cast("long"))
    totals = one_row.selectExpr("""inline(array(
        named_struct('section', 'total', 'item', 'records', 'records', records, 'detail', CAST(NULL AS STRING)),
        named_struct('section', 'total', 'item', 'columns', 'records', columns, 'detail', CAST(NULL AS STRING)),
        named_struct('section', 'total', 'item', 'countries', 'records', countries, 'detail', CAST(NULL AS STRING)),
        named_struct('section', 'total', 'item', 'cities', 'records', cities, 'detail', CAST(NULL AS STRING)),
        named_struct('section', 'total', 'item', 'stations', 'records', stations, 'detail', CAST(NULL AS STRING)),
        named_struct('section', 'total', 'item', 'start', 'records', CAST(NULL AS BIGINT), 'detail', start),
        named_struct('section', 'total', 'item', 'end', 'records', CAST(NULL AS BIGINT), 'detail', `end`)))""")
    return totals.unionByName(items).unionByName(first).unionByName(columns)
