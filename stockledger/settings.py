"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# a column takes about this many times its bytes in the files once it is decoded
EXPANSION = 3
# Dimensions up to this estimated size are broadcast, larger ones shuffled. The
# driver gathers a broadcast and hashes it, which takes several times its rows'
# size there, and joins may do so at once. Spark estimates from compressed files
# unless it is told how far they expand.
BROADCAST_LIMIT = {
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024**2),
    "spark.sql.sources.fileCompressionFactor": str(float(EXPANSION)),
}

# Adaptive execution decides join sides and partition sizes from measured
# sizes. Splitting a skewed join partition is allowed even where the grouping
# after the join would otherwise reuse the join's partitioning, so a key that
# holds a third of the rows never ends up in one task.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
PARTITIONS_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# a shuffle starts with this many tasks per core, and with more when the input
# asks for it; adaptive execution merges the small ones again
WAVES = 3
SHUFFLE_TARGET = 256 * 1024**2

# what was set here, by session: anything else in a session is the user's
_OURS: dict[str, dict[str, str]] = {}


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path as of now, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def tune(spark: SparkSession, *paths: str) -> SparkSession:
    """Apply the adaptive settings where neither job nor session sets them.

    With the paths a job reads, shuffles are also cut for their size, so the
    same code fits eight cores and thousands, megabytes and terabytes. The
    sizes are those of the files at each call.
    """
    for key, value in {**BROADCAST_LIMIT, **ADAPTIVE}.items():
        _offer(spark, key, value)
    width = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        WAVES * spark.sparkContext.defaultParallelism,
    )
    volume = EXPANSION * sum(input_bytes(spark, path) for path in paths)
    _offer(spark, PARTITIONS_KEY, str(max(width, -(-volume // SHUFFLE_TARGET))))
    return spark


def _offer(spark: SparkSession, key: str, value: str) -> None:
    """Set a key that is unset, or that still has what was set here before."""
    ours = _OURS.setdefault(spark.conf.get("spark.app.id", ""), {})
    given = spark.conf.getAll.get(key)
    if given is None or given == ours.get(key):
        spark.conf.set(key, value)
        ours[key] = value


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = tempfile.mkdtemp(prefix="stockledger-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder already chosen."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), "stockledger", f"{name}-{uuid.uuid4().hex}")


def lake_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    region: str = "us-east-1",
    use_ssl: bool = False,
    path_style: bool = True,
) -> dict[str, str]:
    """Builder options that point ``s3a://`` paths at an S3-compatible store.

    The connector jars come with the cluster; nothing here loads them.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": region,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(use_ssl).lower(),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def lake_conf_from_env(env: dict[str, str] | None = None) -> dict[str, str]:
    """``lake_conf`` from the usual S3 environment variables."""
    env = os.environ if env is None else env
    return lake_conf(
        endpoint=env.get("S3_ENDPOINT", "localhost:9000"),
        access_key=env.get("AWS_ACCESS_KEY_ID", ""),
        secret_key=env.get("AWS_SECRET_ACCESS_KEY", ""),
        region=env.get("AWS_DEFAULT_REGION", "us-east-1"),
        use_ssl=env.get("S3_USE_SSL", "false").lower() == "true",
    )
