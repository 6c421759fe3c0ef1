"""Registry lookups as joins, and the grid of expected observations.

No side is marked for broadcast: Spark broadcasts a registry whose size in bytes
is known to be small, before or while the job runs, and otherwise shuffles both
sides and splits the partitions of hot stations.
"""

from pyspark.sql import DataFrame, functions as F

REGISTRY_COLUMNS = [
    "station_name", "country", "city", "latitude", "longitude", "elevation_m", "station_type",
    "industrial_index", "regulation_score", "commissioning_year",
]


def enrich_with_registry(readings: DataFrame, registry: DataFrame, columns=REGISTRY_COLUMNS) -> DataFrame:
    """Station attributes attached to each reading; readings of unknown stations drop out."""
    return readings.join(registry.select("station_id", *columns), "station_id")


def commissioned_only(r: DataFrame, registry: DataFrame, year: str = "year") -> DataFrame:
    """Readings dated in or after the year their station went into service."""
    since = registry.select("station_id", F.col("commissioning_year").alias("_since"))
    return r.join(since, "station_id").filter(F.col(year) >= F.col("_since")).select(*r.columns)


def observation_spine(registry: DataFrame, start: str, end: str, step_h: int = 3) -> DataFrame:
    """Every station at every ``step_h`` hours from ``start`` to the end of the day ``end``, once in service.

    Stations are opened into days first; the days are spread over the cluster
    before they are opened into hours, so a small registry does not put the
    whole grid into one task.
    """
    first = F.greatest(F.to_date(F.lit(start)), F.make_date("commissioning_year", F.lit(1), F.lit(1)))
    last = F.to_date(F.lit(end))
    days = (
        registry.filter(first <= last)
        .select("station_id", F.explode(F.sequence(first, last)).alias("day"))
        .repartition("station_id", "day")
    )
    hours = F.explode(F.sequence(F.lit(0), F.lit(23), F.lit(step_h))).alias("hour")
    at = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour"))
    return days.select("station_id", "day", hours).select("station_id", at.alias("timestamp"))
