"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: str = "8", shuffle_partitions: int = 8, app: str = "spokecast", shared: str | None = None
) -> SparkSession:
    """A single-node session for tests and the bench; on a cluster bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Building plans from Python is faster without a call site kept for every column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back on a temporary folder; on a cluster a
    machine-local path would lose data with its executor, so that case is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.gettempdir() + "/spokecast-shared"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so iterative work does not replay its inputs.

    ``checkpoint`` writes to the shared folder and survives the loss of executors.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
