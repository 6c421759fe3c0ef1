"""The shared folder of a job."""

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables a job writes on its way.

    Taken from ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        folder = _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="skyledger-")
        context.setCheckpointDir(folder)
    return _local_folders[context.applicationId]


_local_folders: dict[str, str] = {}
