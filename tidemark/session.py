"""Session settings and the shared folder that lineage is cut into."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does three jobs here: it coalesces small shuffle partitions,
# splits the partitions of a hot key in joins, and splits hot partitions on write.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Folders of local sessions; they go when the process ends.
_LOCAL_FOLDERS: list[tempfile.TemporaryDirectory] = []


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode.

    A cluster must name a folder all executors reach in ``spark.checkpoint.dir``:
    a folder on one machine would be lost with it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        _LOCAL_FOLDERS.append(
            tempfile.TemporaryDirectory(prefix="tidemark-", ignore_cleanup_errors=True)
        )
        named = _LOCAL_FOLDERS[-1].name
    context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, for tables a job writes on its way."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder, so that later reads of it
    neither recompute it nor depend on the executor that held it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
