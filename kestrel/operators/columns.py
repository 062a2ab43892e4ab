"""Column-set operators: constant-column discovery and drop, distinct counts,
feature-column lists.

All per-column statistics are computed in ONE aggregate over the data (the
surveyed code ran one or two jobs per column).  Only one row of statistics
per column reaches the driver, a size bounded by the schema, not the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, _UNORDERED):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return True


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long form, one row per column:
    ``column_name, n_rows, n_nonnull, is_constant, is_constant_ignoring_null``.

    ``is_constant``: exactly one distinct value when NULL counts as a value
    (so {5, NULL} is not constant, all-NULL is).  ``is_constant_ignoring_null``:
    at most one distinct non-NULL value.  Decided with min/max/count in one
    pass (no distinct, no per-column job, no Expand), so it costs a scan.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = list(columns) if columns else list(fields)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(c)).alias(f"__nn{i}"))
        if _orderable(fields[c]):
            aggs.append((F.min(F.col(c)) == F.max(F.col(c))).alias(f"__eq{i}"))
        else:
            aggs.append((F.count_distinct(F.col(c)) <= 1).alias(f"__eq{i}"))
    stats = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        nn, eq, n = F.col(f"__nn{i}"), F.coalesce(F.col(f"__eq{i}"), F.lit(True)), F.col("__rows")
        one_nonnull = (nn == 0) | eq
        rows.append(F.struct(
            F.lit(c).alias("column_name"),
            n.alias("n_rows"),
            nn.alias("n_nonnull"),
            ((nn == 0) | ((nn == n) & eq)).alias("is_constant"),
            one_nonnull.alias("is_constant_ignoring_null"),
        ))
    return stats.select(F.inline(F.array(*rows)))


def constant_columns(df: DataFrame, null_is_value: bool = True,
                     columns: Sequence[str] | None = None) -> list[str]:
    """Names of constant columns (one aggregate job; one row to the driver)."""
    flag = "is_constant" if null_is_value else "is_constant_ignoring_null"
    prof = column_profile(df, columns).where(F.col(flag)).select("column_name")
    return [r[0] for r in prof.collect()]


def drop_constant_columns(df: DataFrame, null_is_value: bool = True,
                          columns: Sequence[str] | None = None) -> DataFrame:
    """Drop every constant column (really dropping each, not one joined name)."""
    return df.drop(*constant_columns(df, null_is_value, columns))


def column_distinct_counts(df: DataFrame, columns: Sequence[str] | None = None,
                           null_is_value: bool = True, approx: bool = False,
                           rsd: float = 0.05, columns_per_pass: int = 8) -> DataFrame:
    """Long form ``column_name, n_distinct``.

    Exact mode uses ``count(DISTINCT c)`` per column, which Spark plans as one
    Expand + two-level aggregate (shuffle ~ rows x columns).  The columns are
    therefore taken ``columns_per_pass`` at a time: each pass reads only its
    columns and shuffles at most that many rows per input row.
    ``approx=True`` uses HyperLogLog++ sketches merged map-side: one scan and a
    shuffle of one row per task, the form to use on very large tables (100 TB).
    With ``null_is_value`` a NULL present counts as one more value, as
    ``SELECT DISTINCT c`` would.
    """
    cols = list(columns) if columns else df.columns
    step = len(cols) if approx else max(1, columns_per_pass)
    parts = [_distinct_pass(df, cols[i:i + step], null_is_value, approx, rsd)
             for i in range(0, len(cols), max(1, step))]
    return reduce(DataFrame.union, parts)


def _distinct_pass(df: DataFrame, cols: Sequence[str], null_is_value: bool, approx: bool,
                   rsd: float) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        d = F.approx_count_distinct(F.col(c), rsd) if approx else F.count_distinct(F.col(c))
        aggs.append(d.alias(f"__d{i}"))
        aggs.append((F.count(F.lit(1)) > F.count(F.col(c))).alias(f"__null{i}"))
    stats = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        n = F.col(f"__d{i}").cast("bigint")
        if null_is_value:
            n = n + F.col(f"__null{i}").cast("bigint")
        rows.append(F.struct(F.lit(c).alias("column_name"), n.alias("n_distinct")))
    return stats.select(F.inline(F.array(*rows)))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns except ``exclude``, in schema order (a plain difference: a
    listed column absent from the data is not added)."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def table_shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` (bigint), ``n_cols`` (int)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"))
