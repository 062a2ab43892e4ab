"""Keep only the rows of the latest key value (e.g. the newest time bucket)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_only(df: DataFrame, key_col: str) -> DataFrame:
    """Rows whose ``key_col`` equals its global maximum.

    The maximum is a one-row global aggregate (partial max per map task), so
    broadcasting it is size-proven: exactly one row.  The equi-join then runs
    map-side with no shuffle of ``df``.
    """
    mx = df.agg(F.max(key_col).alias("__max"))
    return df.join(F.broadcast(mx), F.col(key_col) == F.col("__max"), "inner").drop("__max")


def latest_window(df: DataFrame, ts_col: str, duration: str) -> DataFrame:
    """Rows of the tumbling window that holds the latest ``ts_col``.

    The maximum of the raw column gives the window's start (one cheap column
    scan, a scalar subquery), and the rows are filtered by it before anything
    is aggregated, so an aggregate of them is computed once."""
    start = (df.agg(F.max(ts_col).alias("__max"))
             .select(F.window("__max", duration)["start"].alias("__start")).scalar())
    return df.where(F.col(ts_col) >= start)
