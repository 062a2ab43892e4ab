"""Stream rate: number of records per time bucket.

``bucket_rate`` is the faithful form: the producer stamps each record with a
bucket number and the stream counts ``count(bucket)`` per bucket (records
without a bucket form a NULL group with rate 0).  ``window_rate`` re-aims the
producer's 10-second bucket as an event-time tumbling window, optionally with
a watermark so that state for closed windows is dropped (without one, state
grows with the number of windows forever).

Both are ordinary streaming aggregates: Spark shuffles by the bucket key with
map-side partial counts, and keeps one state row per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.times import ntz_as_utc, utc_as_ntz


def bucket_rate(df: DataFrame, bucket_col: str = "time_stamp", out_col: str = "rate") -> DataFrame:
    return df.groupBy(bucket_col).agg(F.count(F.col(bucket_col)).alias(out_col))


def window_rate(df: DataFrame, ts_col: str, duration: str = "10 seconds",
                watermark: str | None = None, out_col: str = "rate",
                start_col: str = "window_start") -> DataFrame:
    """``window_start, rate`` per tumbling window of ``ts_col``.

    A ``timestamp_ntz`` column is bucketed as it is; the session's zone plays
    no part.  With a watermark, which needs instants, it is read and written
    back as UTC.
    """
    ts = F.col(ts_col)
    ntz = isinstance(df.schema[ts_col].dataType, T.TimestampNTZType)
    src = df.select((ntz_as_utc(ts) if ntz and watermark else ts).alias("__ts"))
    if watermark:
        src = src.withWatermark("__ts", watermark)
    agg = src.groupBy(F.window("__ts", duration)).agg(F.count(F.col("__ts")).alias(out_col))
    start = F.col("window.start")
    return agg.select((utc_as_ntz(start) if ntz and watermark else start).alias(start_col), out_col)
