"""Object-store access as session configuration (the s3a connector must be on
the classpath; it is not in the offline build image, so this is untested
here).  Reads then go through the same CSV/Parquet sources, in parallel on
the executors; nothing is downloaded to the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure_s3a(spark: SparkSession, access_key: str | None = None,
                  secret_key: str | None = None, endpoint: str | None = None,
                  path_style: bool | None = None) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if access_key:
        conf.set("fs.s3a.access.key", access_key)
    if secret_key:
        conf.set("fs.s3a.secret.key", secret_key)
    if endpoint:
        conf.set("fs.s3a.endpoint", endpoint)
    if path_style is not None:
        conf.set("fs.s3a.path.style.access", str(path_style).lower())
