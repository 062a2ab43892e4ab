"""Row filters on labels.

NULL rules are explicit: ``!=`` and ``NOT IN`` drop NULL rows (SQL
three-valued logic), which is what the surveyed pipeline relies on; pass
``keep_nulls=True`` to keep them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def exclude_equal(df: DataFrame, column: str, value, keep_nulls: bool = False) -> DataFrame:
    cond = F.col(column) != F.lit(value)
    if keep_nulls:
        cond = cond | F.col(column).isNull()
    return df.where(cond)


def exclude_values(df: DataFrame, column: str, values: Sequence, keep_nulls: bool = False) -> DataFrame:
    """``column NOT IN values`` (a literal list; Catalyst folds it into an
    ``InSet`` and pushes it to the scan)."""
    cond = ~F.col(column).isin(list(values))
    if keep_nulls:
        cond = cond | F.col(column).isNull()
    return df.where(cond)


def drop_nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))


def _threshold(counts: DataFrame, min_count: int | None, min_share: float | None) -> Column:
    """The least count; a share is of all rows, i.e. of the sum of the counts
    (a scalar subquery that reuses their exchange, not another scan)."""
    if (min_count is None) == (min_share is None):
        raise ValueError("give exactly one of min_count / min_share")
    if min_count is not None:
        return F.lit(min_count)
    return F.lit(float(min_share)) * counts.agg(F.sum("__n")).scalar()


def rare_values(df: DataFrame, column: str, min_count: int | None = None,
                min_share: float | None = None) -> DataFrame:
    """Values of ``column`` seen fewer than the threshold times.

    Threshold is ``min_count`` rows, or ``min_share`` of all rows (data-scaled).
    The count is a partial (map-side) aggregate, so a hot value costs one row
    per map task in the shuffle.
    """
    counts = _value_counts(df, column)
    return counts.where(F.col("__n") < _threshold(counts, min_count, min_share)).select(column)


_UNHASHABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _hashable(df: DataFrame) -> list[Column]:
    """Columns ``xxhash64`` accepts (maps and variants are not, nor is anything
    that holds one)."""
    def ok(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return ok(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(ok(f.dataType) for f in kind.fields)
        return not isinstance(kind, _UNHASHABLE)
    return [F.col(f.name) for f in df.schema.fields if ok(f.dataType)]


def drop_rare_values(df: DataFrame, column: str, min_count: int | None = None,
                     min_share: float | None = None, keep_nulls: bool = False,
                     salt_buckets: int | None = None, max_heavy: int = 1000) -> DataFrame:
    """Remove rows whose value is rarer than the threshold.

    Left-anti join against the rare-value set (one row per distinct rare
    value).  When that set is small AQE broadcasts it from its measured size
    and the rows are not shuffled at all.  Otherwise it is a sort-merge join
    on the value, and a hot value would put all its rows into one task; AQE
    cannot split that partition, because the rare side comes straight off an
    aggregate on the same key and has no shuffle of its own.  So the join
    key is (value, salt): values holding at least ``1 / max_heavy`` of all
    rows (at most ``max_heavy`` of them, so broadcasting them is size-proven)
    are tagged map-side and their rows spread over ``salt_buckets`` salts by
    a row hash; all other rows, and the rare set, take salt 0.  A heavy value
    is never rare (its count is at least the threshold), so the rare side
    needs no replication.  NULL labels are dropped first unless
    ``keep_nulls`` (as ``NOT IN`` would); kept NULL rows never match and are
    spread like a heavy value.
    """
    if not 1 <= max_heavy <= 1_000_000:
        raise ValueError("max_heavy bounds a broadcast: give 1 to 1,000,000")
    c = F.col(column)
    counts = _value_counts(df, column)
    threshold = _threshold(counts, min_count, min_share)
    # salt 0, written as an expression of the data: a literal would be folded
    # into the join condition and drop the salt from the join keys
    rare = counts.where(F.col("__n") < threshold).select(
        column, (F.col("__n") * F.lit(0)).cast("int").alias("__salt"))
    total = counts.agg(F.sum("__n")).scalar()
    heavy = counts.where(c.isNotNull() & (F.col("__n") >= threshold)
                         & (F.col("__n") >= total / F.lit(max_heavy))).select(
        column, F.lit(True).alias("__heavy"))
    rows = df if keep_nulls else df.where(c.isNotNull())
    buckets = salt_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    tagged = rows.join(F.broadcast(heavy), on=column, how="left")
    spread = F.col("__heavy").isNotNull() | c.isNull()
    salted = tagged.withColumn("__salt", F.when(
        spread, F.pmod(F.xxhash64(*_hashable(rows)), F.lit(buckets)).cast("int"))
        .otherwise(F.lit(0)))
    return salted.join(rare, on=[column, "__salt"], how="left_anti").select(*df.columns)


def drop_nan_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL or NaN in any of ``columns`` removed (the assembler's
    ``handleInvalid='skip'`` rule, as an explicit filter)."""
    cond = F.lit(True)
    for c in columns:
        col = F.col(c)
        cond = cond & col.isNotNull() & ~F.isnan(col.cast("double"))
    return df.where(cond)


def invalid_feature_counts(df: DataFrame, columns: Sequence[str],
                           label_col: str | None = None) -> DataFrame:
    """One row: ``n_rows``, ``n_invalid`` (rows ``drop_nan_rows`` removes)
    and ``invalid_<c>`` per column (rows NULL or NaN in it), all in one
    aggregate pass, so a caller can report what the skip rule dropped; with
    ``label_col`` also ``n_null_label``, the rows a fit can't learn from."""
    def bad(c: str) -> Column:
        col = F.col(c)
        return col.isNull() | F.isnan(col.cast("double"))
    any_bad = F.lit(False)
    for c in columns:
        any_bad = any_bad | bad(c)
    label = [F.count_if(F.col(label_col).isNull()).alias("n_null_label")] if label_col else []
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(any_bad).alias("n_invalid"), *label,
                  *[F.count_if(bad(c)).alias(f"invalid_{c}") for c in columns])


def collapse_to_binary(column: str, negative) -> Column:
    """``when(c != negative, 1.0).otherwise(c)``: every non-negative class -> 1.0."""
    c = F.col(column)
    return F.when(c != F.lit(negative), F.lit(1.0)).otherwise(c.cast("double"))
