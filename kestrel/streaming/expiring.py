"""Rate per integer bucket with state that expires.

``rate.bucket_rate`` keeps a state row for every bucket number ever seen.  The
numbers grow with time, so they can serve as event time: bucket ``n`` is read as
second ``n``, the watermark trails the highest number by ``lag`` buckets, and
Append mode emits a bucket once, when it is ``lag`` behind, and drops its state.
State is at most the rows of ``lag`` buckets, however long the stream runs; it
is Spark's own aggregate, so nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a stream's watermark begins at second 0 and drops what is not later, so
#: numbers from -2^32 on are moved past it
_SHIFT = 1 << 32


def expiring_bucket_rate(df: DataFrame, bucket_col: str = "time_stamp", lag: int = 1, out_col: str = "rate") -> DataFrame:
    """``bucket_col, out_col`` for each closed bucket, i.e. one that is at least
    ``lag`` below the highest number seen.  Records that come later are dropped,
    as are those without a bucket, which no number can ever close."""
    if lag < 1:
        raise ValueError("lag counts buckets, from 1: the highest one may still grow")
    marked = (df.where(F.col(bucket_col).isNotNull()).select(F.timestamp_seconds(F.col(bucket_col).cast("long") + _SHIFT).alias("__second"))
              .withWatermark("__second", f"{lag} seconds"))
    kind = df.schema[bucket_col].dataType
    return (marked.groupBy("__second").agg(F.count(F.lit(1)).alias(out_col))
            .select((F.unix_seconds("__second") - _SHIFT).cast(kind).alias(bucket_col), out_col))
