"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job should carry. Partition counts follow the data through
# adaptive coalescing; the advisory size keeps a shuffle partition well inside
# an executor's memory.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> bool:
    """Use the shared checkpoint folder named in ``spark.checkpoint.dir``.

    ``fallback`` applies only where the session names none, as in tests.
    Returns whether a checkpoint folder is set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return True
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        return False
    context.setCheckpointDir(folder)
    return True


def require_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local session without one gets a temporary folder."""
    if not ensure_checkpoint_dir(spark):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="checkpoints-"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, its lineage cut."""
    require_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for ``name`` under the shared checkpoint folder."""
    unique = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    return f"{require_checkpoint_dir(spark)}/{name}-{unique}"
