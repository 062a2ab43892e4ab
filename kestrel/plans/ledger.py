"""Stage-timing ledger: record rows, and analyse them as DataFrames.

Ledger rows are ``file_name, function_name, description, time_taken``.
Analysis: the slowest stage (top-k), the total time (optionally excluding a
file), and method-pair comparisons by function name (not by row position).
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.sampling import first_n
from kestrel.schemas import LEDGER_SCHEMA


class Ledger:
    """Collects timing rows on the driver (a handful per job) and appends them
    to a shared table in one write."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str, str, float]] = []

    @contextmanager
    def stage(self, file_name: str, function_name: str, description: str = ""):
        t0 = time.perf_counter()
        try:
            yield
        finally:
            self.rows.append((file_name, function_name, description, time.perf_counter() - t0))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, LEDGER_SCHEMA)

    def append_to(self, spark: SparkSession, path: str, fmt: str = "parquet") -> None:
        self.frame(spark).write.mode("append").format(fmt).save(path)


def top_stages(ledger: DataFrame, n: int = 1, exclude_file: str | None = None,
               time_col: str = "time_taken", key_cols: Sequence[str] = ("file_name", "function_name", "description")) -> DataFrame:
    """The ``n`` slowest stages (ties broken by the name columns)."""
    src = ledger if exclude_file is None else ledger.where(F.col("file_name") != exclude_file)
    return first_n(src, n, [time_col, *key_cols], ascending=False)


def total_time(ledger: DataFrame, exclude_file: str | None = None,
               time_col: str = "time_taken", digits: int = 6) -> DataFrame:
    src = ledger if exclude_file is None else ledger.where(F.col("file_name") != exclude_file)
    return src.agg(F.round(F.sum(time_col), digits).alias("total_time"),
                   F.count(F.lit(1)).alias("n_stages"))


def compare_pairs(ledger: DataFrame, pairs: Sequence[tuple[str, str]],
                  name_col: str = "function_name", time_col: str = "time_taken",
                  digits: int = 6) -> DataFrame:
    """For each (a, b) pair of function names: total time of each and a/b.

    The pair list is a parameter, so the literal frame joined to the ledger is
    bounded by it and broadcast.
    """
    spark = ledger.sparkSession
    # one literal row per (pair, side): built JVM-side, size = 2 x len(pairs)
    long = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("method_a"), F.lit(b).alias("method_b"),
                 F.lit(side).alias("side"), F.lit(name).alias("name"))
        for a, b in pairs for side, name in (("a", a), ("b", b))])))
    joined = ledger.join(F.broadcast(long), ledger[name_col] == long["name"], "inner")
    agg = joined.groupBy("method_a", "method_b").agg(
        F.sum(F.when(F.col("side") == "a", F.col(time_col))).alias("time_a"),
        F.sum(F.when(F.col("side") == "b", F.col(time_col))).alias("time_b"))
    return agg.select("method_a", "method_b",
                      F.round("time_a", digits).alias("time_a"),
                      F.round("time_b", digits).alias("time_b"),
                      F.round(F.col("time_a") / F.col("time_b"), digits).alias("ratio"))
