"""Cutting lineage, and broadcasting behind a check of the size."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows, and bytes as JSON, that a table may have to be broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; in local mode a temporary one where that's unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return folder or tempfile.mkdtemp(prefix="spark-")


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, computed once, with a hint to broadcast it if it has no more than ``rows`` rows and BROADCAST_BYTES bytes."""
    df = checkpointed(df)
    n, size = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df
