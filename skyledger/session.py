"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession

# HotSpot does not compile methods above 8000 bytes of bytecode; wide projections
# then run faster without whole-stage code generation (Spark's own documentation
# suggests this value for HotSpot).
HOTSPOT_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings of a session of our own. Adaptive execution sizes the reduce side:
# it joins small shuffle partitions and splits those of hot keys.
BUILD_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name: str = "skyledger", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; the master is left to ``spark-submit`` unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_SETTINGS, **HOTSPOT_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def with_settings(spark: SparkSession) -> SparkSession:
    """The session itself; settings for HotSpot that it was not started with are set, those it was given stay."""
    for key, value in HOTSPOT_SETTINGS.items():
        if key not in spark.conf.getAll:
            spark.conf.set(key, value)
    return spark
