"""Deduplication (whole-row and per column).

``dropDuplicates()`` and ``distinct()`` compile to the same plan: a hash
aggregate on all columns with a map-side partial aggregate, so duplicates are
collapsed before the shuffle.  A single hot row value is therefore reduced
to one row per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Whole-row dedup (or on ``subset``; then an arbitrary row per key is kept)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT cols`` (projection first, so the scan is pruned)."""
    return (df.select(*columns) if columns else df).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column (NULL included once if present)."""
    return df.select(column).distinct()
