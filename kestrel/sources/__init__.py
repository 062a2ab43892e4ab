"""Batch sources and sinks: CSV (plain, gzip, object store), Parquet, JDBC."""

from kestrel.sources.files import (read_connections_csv, read_csv, read_ledger_csv,
                                   write_csv, write_parquet, write_single_csv)
from kestrel.sources.jdbc import jdbc_bounds, read_jdbc, read_jdbc_partitioned, write_jdbc
from kestrel.sources.object_store import configure_s3a

__all__ = [n for n in dir() if not n.startswith("_")]
