"""Lineage cuts: a table written to the shared folder of ``spark.checkpoint.dir``.

Unlike a cache, the rows survive a lost executor; unlike ``localCheckpoint``
nothing is kept on one machine.  The folder's owner clears it (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from kestrel.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh shared folder and read it back."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
