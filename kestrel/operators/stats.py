"""Descriptive statistics (all hash aggregates with map-side partials, so a
hot group is pre-aggregated before the shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, count_rows: bool = True,
                 out_col: str = "n", ordered: bool = True) -> DataFrame:
    """Count per value.

    ``count_rows=True`` is ``count(*)`` (a NULL group counts its rows);
    ``False`` is ``count(column)`` (the NULL group counts 0).
    """
    agg = F.count(F.lit(1)) if count_rows else F.count(F.col(column))
    out = df.groupBy(column).agg(agg.alias(out_col))
    return out.orderBy(column) if ordered else out


def category_stats(df: DataFrame, category_col: str, value_col: str,
                   positive_threshold: float = 0.0, digits: int = 6) -> DataFrame:
    """Per category: ``avg_<v>`` (rounded), ``nonnull_<v>`` (``count(v)``, the
    notebook's "attempts") and ``positive_<v>`` (``count_if(v > t)``, what the
    prose meant)."""
    v = F.col(value_col)
    return df.groupBy(category_col).agg(
        F.round(F.avg(v), digits).alias(f"avg_{value_col}"),
        F.count(v).alias(f"nonnull_{value_col}"),
        F.count_if(v > F.lit(positive_threshold)).alias(f"positive_{value_col}"),
    )


def total(df: DataFrame, column: str, out_col: str = "total", digits: int | None = 6) -> DataFrame:
    s = F.sum(F.col(column))
    return df.agg((F.round(s, digits) if digits is not None else s).alias(out_col))
