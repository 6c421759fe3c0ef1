"""Reading the columns an operator needs, whatever else a table holds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pick(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns, cast to the given types and nothing else.

    Columns are taken by position of the exact name (the first, if a name is
    repeated), so that extra columns may have any name, even one that differs
    only in case or one the operator gives to its own results.
    """
    places = [df.columns.index(name) for name in kinds]
    plain = df.toDF(*[f"_in_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_in_{i}").cast(kind).alias(name) for i, (name, kind) in zip(places, kinds.items(), strict=True)])


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(session: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors share.

    One is made here only where a session has none and runs on one machine,
    which is the case in tests.
    """
    context = session.sparkContext
    folder = session.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="skyledger-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """The frame cut from its lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder as a Parquet table and read again."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
