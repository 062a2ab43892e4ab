"""File sources and sinks.

CSV is read with a declared schema (never inferred), headerless, PERMISSIVE:
short rows give NULL tails, malformed numbers NULL, extra fields are ignored.
Gzip input is not splittable, so a ``.gz`` file is one task; pass
``repartition`` to spread the rows before heavy work.  Object-store paths
(``s3a://...``) are read the same way once the connector is configured
(``configure_s3a``); nothing is downloaded to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.schemas import CONNECTION_SCHEMA, LEDGER_SCHEMA
from kestrel.session import cached


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
             sep: str = ",", header: bool = False, repartition: int | None = None,
             mode: str = "PERMISSIVE", **options) -> DataFrame:
    df = (spark.read.schema(schema).option("sep", sep).option("header", header)
          .option("mode", mode).options(**options).csv(path))
    return df.repartition(repartition) if repartition else df


def read_connections_csv(spark: SparkSession, path: str | list[str],
                         repartition: int | None = None) -> DataFrame:
    """The 42-column connection log (plain or ``.gz``; local, HDFS or s3a)."""
    return read_csv(spark, path, CONNECTION_SCHEMA, repartition=repartition)


def read_ledger_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Stage-timing ledger lines ``file, function, description, seconds``.

    Fields carry a leading blank (and the number a trailing one): the strings
    are trimmed, the number parses with surrounding blanks ignored.
    """
    df = read_csv(spark, path, LEDGER_SCHEMA, ignoreLeadingWhiteSpace=True,
                  ignoreTrailingWhiteSpace=True)
    return df.select(*[F.trim(F.col(c)).alias(c) if c != "time_taken" else F.col(c)
                       for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False,
              compression: str | None = None, **options) -> None:
    w = df.write.mode(mode).option("header", header).options(**options)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True,
                     order_by: list[str] | None = None, max_rows: int = 1_000_000) -> None:
    """A small report (e.g. counts per label) as ONE headed CSV file, rows in
    ``order_by`` order.

    Only for an already-aggregated frame.  ``repartition(1)`` rather than
    ``coalesce(1)``: coalesce is a narrow dependency and would pull the
    aggregate's final stage into the single task too, while the extra shuffle
    moves only the aggregated rows.  The order is set inside that one
    partition, since a shuffle drops any earlier sort.  More than ``max_rows``
    rows are an error: one task would have to write them all.
    """
    with cached(df):
        n = df.count()
        if n > max_rows:
            raise ValueError(f"{n} rows for one file; write_csv writes many, or raise max_rows")
        one = df.repartition(1)
        if order_by:
            one = one.sortWithinPartitions(*order_by)
        one.write.mode("overwrite").option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
