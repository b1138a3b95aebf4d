"""Session helpers: reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; make one only for local runs that set none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
    context.setCheckpointDir(configured)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `df` only after counting that it is small; otherwise leave a shuffle join. The count is added up
    from the tasks, no rows are brought together for it."""
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by `keys` into the session's number of partitions, ahead of Python work per group.

    Naming the number keeps adaptive execution from merging partitions that are small in bytes but
    not in work.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
