"""Intermediate results that several branches of one answer read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def written_once(df: DataFrame) -> DataFrame:
    """``df`` computed now, once, and kept below the shared checkpoint folder.

    For what several branches read: Spark only reuses a shuffle if all branches come to the very same
    plan below it, which pruning, pushed filters and runtime re-planning of joins easily undo. The
    files survive lost executors, and go when the frame is no longer used (a cluster sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``; ``get_session`` does).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
