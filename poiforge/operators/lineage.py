"""Cutting the lineage of loops and cascades, the shared folder, and broadcasts of a checked size."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a narrow table may be broadcast.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own in local mode, where that is unset."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and (not context.master.startswith("local") or "cluster" in context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(at or "file://" + tempfile.mkdtemp(prefix="poiforge-"))
    return (spark.conf.get("spark.checkpoint.dir", None) or context._jsc.sc().getCheckpointDir().get()).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if a count stays under the bound; else Spark shuffles both sides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
