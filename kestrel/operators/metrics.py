"""Binary classification metrics as one DataFrame aggregate.

Every class other than ``negative`` is collapsed to "positive" (the surveyed
code's ``when(c != 0.0, 1.0)``), then a single pass of conditional sums gives
the confusion counts; the ratios are computed on that one-row result.  No RDD
hop, no sort, no driver-side loop.

Undefined ratios are NULL, except precision with no positive prediction,
which is 0.0 (as MLlib reports it).  Rows with a NULL prediction or label are
not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def binary_metrics(df: DataFrame, prediction_col: str, label_col: str, negative,
                   digits: int | None = 6) -> DataFrame:
    """One row: ``tp, fp, tn, fn, false_positive_rate, precision, recall, accuracy``."""
    p, y = F.col(prediction_col), F.col(label_col)
    valid = df.where(p.isNotNull() & y.isNotNull())
    pos_p = p != F.lit(negative)
    pos_y = y != F.lit(negative)
    counts = valid.agg(
        F.count_if(pos_p & pos_y).alias("tp"),
        F.count_if(pos_p & ~pos_y).alias("fp"),
        F.count_if(~pos_p & ~pos_y).alias("tn"),
        F.count_if(~pos_p & pos_y).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))

    def ratio(num, den):
        r = F.when(den > 0, num / den)
        return F.round(r, digits) if digits is not None else r

    return counts.select(
        "tp", "fp", "tn", "fn",
        ratio(fp, fp + tn).alias("false_positive_rate"),
        F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
    )
