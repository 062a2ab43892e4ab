"""Exploration report: the aggregates behind the dashboard charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.columns import table_shape
from kestrel.operators.stats import category_stats, value_counts


def exploration_report(df: DataFrame, label_col: str = "attack", category_col: str = "category",
                       duration_col: str = "duration", attempt_col: str = "su_attempted") -> dict[str, DataFrame]:
    """Lazy frames; the caller decides which to materialise."""
    return {
        "shape": table_shape(df),
        "label_counts": value_counts(df, label_col, count_rows=False),
        "category_counts": value_counts(df, category_col, count_rows=False),
        "duration_by_category": category_stats(df, category_col, duration_col),
        "attempts_by_category": category_stats(df, category_col, attempt_col),
    }


def long_report(report: dict[str, DataFrame]) -> DataFrame:
    """The frames as one table: section, label (the frame's text column, if it
    has one), measure (the number's column) and value.  Frames are aggregates,
    a row per label, so the union is small whatever the input."""
    rows = []
    for section, df in report.items():
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        label = F.col(f"`{text[0]}`") if text else F.lit(None).cast("string")
        measures = [F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").cast("double").alias("value"))
                    for c in df.columns if c not in text]
        rows.append(df.select(F.lit(section).alias("section"), label.alias("label"), F.inline(F.array(*measures))))
    return reduce(DataFrame.union, rows)
