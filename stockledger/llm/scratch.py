"""Tables that a job writes and reads again, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; on a cluster the call fails, since a
    machine's own folder is not seen by the other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Lets shuffle files go when a query ends. Otherwise they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared folder: its rows are fixed, its lineage ends here and its shuffles' files go."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.getAll.get(CLEANUP)
    if before is None:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)
