"""Rows by their place in the files they were read from.

A frame that comes straight from a file reader knows each row's file and, for
Parquet, its row number; other formats know the split it came from, and a
split's rows follow each other within a task.  Rows per file (or split) are
counted, their running sum gives every file its first position (one row per
file or split is all that one task sees), and a row's position is its file's
start plus its place in it: a unique bigint, the same however the files were
split.  Rows are neither sorted nor moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.sampling import first_n, last_n

_PLACE = "__place_"


def _placed(df: DataFrame, parquet: bool) -> DataFrame:
    meta = {"file": F.col("_metadata.file_path"), "time": F.col("_metadata.file_modification_time")}
    if parquet:
        meta |= {"block": F.lit(0).cast("long"), "row": F.col("_metadata.row_index")}
    else:
        # a task reads its splits one after another, so rows of a split have consecutive ids
        meta |= {"block": F.col("_metadata.file_block_start"), "row": F.monotonically_increasing_id()}
    return df.select("*", *[c.alias(f"{_PLACE}{n}") for n, c in meta.items()])


def with_position(df: DataFrame, out_col: str = "position", parquet: bool = True, by_time: bool = False) -> DataFrame:
    """``df`` (straight from a reader, unfiltered) with each row's 0-based place
    in the whole input.  Files follow each other by path, or by modification
    time and path (``by_time``).  Formats other than Parquet (``parquet=False``)
    are counted and numbered in two reads, which must meet the same files and
    settings; compressed or multi-line files are one split each."""
    if out_col in df.columns:
        raise ValueError(f"the rows already have a column {out_col}")
    placed = _placed(df, parquet)
    key = [f"{_PLACE}file", f"{_PLACE}block"]
    splits = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(f"{_PLACE}row").alias("low"), F.min(f"{_PLACE}time").alias("time"))
    order = [*(["time"] if by_time else []), *key]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)      # a row per file or split
    starts = splits.select(*key, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias(f"{_PLACE}start"))
    out = placed.join(starts, key)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(f"{_PLACE}start") + F.col(f"{_PLACE}row")).alias(out_col))


def tail_by_position(df: DataFrame, n: int, **kw) -> DataFrame:
    """The last ``n`` rows of the input, with their ``position``."""
    return last_n(with_position(df, **kw), n, ["position"])


def head_by_position(df: DataFrame, n: int, **kw) -> DataFrame:
    """The first ``n`` rows of the input, with their ``position``."""
    return first_n(with_position(df, **kw), n, ["position"])


def between_positions(df: DataFrame, low: int, high: int, **kw) -> DataFrame:
    """Rows at positions ``low`` to ``high - 1``."""
    place: Column = F.col("position")
    return with_position(df, **kw).where((place >= low) & (place < high))
