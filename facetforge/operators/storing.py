"""Cutting lineage in the folder that driver and executors share, and joins that keep clear of the driver."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """The table written to the checkpoint folder that all executors share; to a temporary one only in local mode."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        at = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not at and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(at or tempfile.mkdtemp(prefix="facetforge-"))
    return df.checkpoint()


def dealt(df: DataFrame) -> DataFrame:
    """One side of a join of which both sides grow with the input: both are dealt out by the key. Otherwise Spark sends a side
    that is still small enough whole through the driver, once for each such join."""
    return df.hint("merge")
