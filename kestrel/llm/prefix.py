"""Running sums over one global order, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.scratch import written


def running_sums(df: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Add for each ``new: column`` of ``sums`` the inclusive running sum of
    ``column`` in ascending ``order`` (nulls first, as Spark sorts them).

    Rows are range-partitioned by ``order``; each range is summed, the sums of
    the ranges (one row per partition) are accumulated, and a window within
    each range adds its start.  The ranges are written to the shared folder,
    so that a lost executor can't change them between the two passes."""
    parts = written(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    total = parts.groupBy("__range").agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()])
    # one row per range, so this window holds as many rows as there are partitions
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = total.select("__range", *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__start_{n}")
                                       for n in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = parts.join(starts, "__range")
    for n, c in sums.items():
        out = out.withColumn(n, F.sum(c).over(inside) + F.col(f"__start_{n}"))
    return out.drop("__range", *[f"__start_{n}" for n in sums])
