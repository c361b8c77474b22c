"""Session settings and the shared folder used to cut long lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. A cluster adds its own sizes (executors, memory, partitions).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # needed by the stateful streaming operator only
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def split_skew(spark: SparkSession) -> None:
    """Turn on what splits hot keys in lookup joins, for a session not made by :func:`configure`."""
    for key in ("skewJoin.enabled", "forceOptimizeSkewedJoin"):
        if spark.conf.get(f"spark.sql.adaptive.{key}", "false") != "true":
            spark.conf.set(f"spark.sql.adaptive.{key}", "true")


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder for checkpoints: the cluster's ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode with nothing set; on a cluster a missing
    setting is an error, since a machine-local folder does not survive the loss of an executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="flowtables-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that later reads see one fixed result."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table written on the way."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the lineage like :func:`cut`,
    compressed and by column, so that later reads take the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
