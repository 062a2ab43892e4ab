"""Capping, head/tail samples, relabelling, rebalancing and splits.

Every pick is deterministic: callers give an order key (which must be total,
i.e. end in a unique column) and a seed; nothing relies on LIMIT without
ORDER BY, on row ids or on an unseeded ``rand()``.

Scale design of the "first n rows by order" primitive (``first_n``), which all
caps, heads, tails and relabels use:

1. ``n`` up to Spark's ``windowGroupLimitThreshold``: every map task keeps its
   first n rows per group (``WindowGroupLimit``), so the shuffle holds at most
   n rows per task and group.  They are merged in two levels: ``salt_buckets``
   sets of map tasks first, then the sets.  A hot value is cut in the tasks
   that read it and never meets in one place.
2. Larger ``n``: the exact cut is found first, in two histogram rounds over a
   monotone integer code of the first order column (``ordinal``): the bucket
   that holds the n-th row, then the sub-bucket inside it (``key_bucket``,
   ``sub_bucket``).  Only code counts are shuffled, one row per populated
   bucket and task.  The cut is one row per group, applied as a filter (whole
   table: scalar subqueries; groups: a broadcast of one row per group).  About
   n rows per group survive it, or more where many tie on the first order
   column, or share its first seven bytes.  The survivors are range-partitioned
   by the whole order, which is total, so that ties spread like other rows, and
   counts per range tell which ranges are taken whole and where to cut.

Which of the two runs depends on ``n`` alone, not on the data or its size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.hashing import hash_key, hash_pick
from kestrel.functions.times import ntz_as_utc

KEY_BITS = 60       # of hash_key
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _order(order_by: Sequence[str], ascending: bool) -> list[Column]:
    return [F.col(c).asc() if ascending else F.col(c).desc() for c in order_by]


def _salt_buckets(df: DataFrame, salt_buckets: int | None) -> int:
    if salt_buckets:
        return salt_buckets
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, math.isqrt(width))


def ordinal(df: DataFrame, column: str) -> Column | None:
    """A bigint that never decreases along the column's sort order (NULL stays
    NULL); None for types without one.  Integers, dates, timestamps and
    floating-point numbers are coded exactly, decimals as doubles, strings by
    their first seven bytes."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, _INTEGRAL):
        return c.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(ntz_as_utc(c))
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        x = c.cast("double")
        a = F.abs(x)
        usual = (a >= F.lit(2.2250738585072014e-308)) & (a < F.lit(float("inf")))
        e = F.floor(F.log2(F.when(usual, a).otherwise(F.lit(1.0))))
        e = (F.when(F.pow(F.lit(2.0), e) > a, e - 1)
             .when(F.pow(F.lit(2.0), e + 1) <= a, e + 1).otherwise(e))
        fraction = ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(float(1 << 52))).cast("bigint")
        code = (F.when(usual, (e + 1023) * F.lit(1 << 52) + fraction)
                .when(a < 1, F.lit(0)).otherwise(F.lit(2047 << 52)))
        return (F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x >= 0, code).when(x < 0, -code - 1))
    if isinstance(kind, T.StringType):
        seven = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(seven, 16, 10).cast("bigint")
    return None


def key_bucket(col: Column | str, ascending: bool = True, mantissa_bits: int = 12) -> Column:
    """Monotone log-linear bucket of an integral key (no min/max pass needed).

    For x >= 0 with bit length L: x itself when L <= mantissa_bits, else
    ``(L - m) * 2^m + (x >> (L - m))``, i.e. the top m bits plus the exponent,
    so a bucket spans at most 2^-(m-1) of its key's magnitude.  Negative keys
    mirror below zero.  Descending order negates the code.  NULL keys get a
    sentinel that sorts where Spark puts NULLs (first ascending, last
    descending).  The code space has fewer than 64 * 2^m values.
    """
    m = mantissa_bits
    k = (F.col(col) if isinstance(col, str) else col).cast("bigint")

    def code(x: Column) -> Column:
        shift = F.greatest(F.length(F.bin(x)) - F.lit(m), F.lit(0))
        return (shift.cast("bigint") * F.lit(1 << m)
                + F.call_function("shiftright", x, shift.cast("int")))

    b = F.when(k >= 0, code(k)).otherwise(-code(-(k + F.lit(1))) - F.lit(1))
    if not ascending:
        b = -b - F.lit(1)
    return F.coalesce(b, F.lit(-(1 << 62) if ascending else (1 << 62)))


def sub_bucket(col: Column | str, ascending: bool = True, mantissa_bits: int = 12,
               sub_bits: int = 12) -> Column:
    """Position of an integral key inside its ``key_bucket``: the next
    ``sub_bits`` bits below the bucket's top ``mantissa_bits`` (0 where the
    bucket holds a single key value).  Monotone in the key among keys of one
    bucket, in the same direction as ``key_bucket``; NULL keys get 0."""
    m, s2 = mantissa_bits, sub_bits
    k = (F.col(col) if isinstance(col, str) else col).cast("bigint")

    def pos(x: Column) -> Column:
        shift = F.greatest(F.length(F.bin(x)) - F.lit(m), F.lit(0)).cast("int")
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - F.lit(1)
        return F.call_function("shiftright", x.bitwiseAND(low),
                               F.greatest(shift - F.lit(s2), F.lit(0)).cast("int"))

    p = F.when(k >= 0, pos(k)).otherwise(-pos(-(k + F.lit(1))))
    if not ascending:
        p = -p
    return F.coalesce(p, F.lit(0))


def _group_eq(groups: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for i, g in enumerate(groups):
        cond = cond & F.col(g).eqNullSafe(F.col(f"{prefix}{i}"))
    return cond


def _renamed(df: DataFrame, groups: Sequence[str], prefix: str, *cols: Column) -> DataFrame:
    return df.select(*[F.col(g).alias(f"{prefix}{i}") for i, g in enumerate(groups)], *cols)


def _cutoff_filter(df: DataFrame, n: int, key: str, ascending: bool, mantissa_bits: int,
                   groups: Sequence[str] = (), sub_bits: int | None = 12) -> DataFrame:
    """Rows that can be among the first ``n`` (per group when ``groups`` are
    given); every row where fewer than ``n`` exist.

    Round 1: counts per ``key_bucket`` code and a running sum over them give
    the bucket that holds the n-th row.  Round 2 (skipped when ``sub_bits`` is
    None): the same per ``sub_bucket`` code over that bucket's rows.  Both
    codes are monotone in the key, so the rows up to the n-th row's sub-bucket
    hold every top-n row: the cut is exact.

    Without groups the cut is applied by scalar subqueries.  With groups it is
    a table of one row per group; their number is counted, and up to
    ``BROADCAST_MAX_ROWS`` of them are broadcast, so that no full row is
    shuffled.  Beyond that it is a shuffle join.
    """
    if not 1 <= mantissa_bits <= 20 or not 1 <= (sub_bits or 1) <= 20:
        raise ValueError("mantissa_bits and sub_bits bound the histograms: give 1 to 20")
    gnames = list(groups)
    code = ordinal(df, key)
    rows = df.withColumns({"__b": key_bucket(code, ascending, mantissa_bits),
                           "__s": (sub_bucket(code, ascending, mantissa_bits, sub_bits)
                                   if sub_bits is not None else F.lit(0).cast("bigint"))})

    def running(counts: DataFrame, by: str, start: Column) -> DataFrame:
        w = (Window.partitionBy(*gnames).orderBy(by).rowsBetween(Window.unboundedPreceding, -1))
        before = counts.withColumn("__before", start + F.coalesce(F.sum("__c").over(w), F.lit(0)))
        return before.where((F.col("__before") < F.lit(n)) & (F.col("__before") + F.col("__c") >= F.lit(n)))

    cut = running(rows.groupBy(*gnames, "__b").agg(F.count(F.lit(1)).alias("__c")), "__b", F.lit(0))
    work = ["__b", "__s"]
    if not gnames:
        at = cut.select("__b").scalar()
        keep = F.col("__b") <= at
        if sub_bits is not None:
            inside = rows.where(F.col("__b") == at).groupBy("__s").agg(F.count(F.lit(1)).alias("__c"))
            sub = running(inside, "__s", cut.select("__before").scalar()).select("__s").scalar()
            keep = (F.col("__b") < at) | ((F.col("__b") == at) & (F.col("__s") <= sub))
        return rows.where(at.isNull() | keep).drop(*work)
    cut = _renamed(cut, gnames, "__k", F.col("__b").alias("__cb"), F.col("__before").alias("__cbefore"))
    few = df.select(*gnames).distinct().count() <= BROADCAST_MAX_ROWS
    hint = F.broadcast if few else (lambda t: t)
    if sub_bits is not None:
        inside = (rows.join(hint(cut), (F.col("__b") == F.col("__cb")) & _group_eq(gnames, "__k"))
                  .groupBy(*gnames, "__cb", "__cbefore", "__s").agg(F.count(F.lit(1)).alias("__c")))
        cut = _renamed(running(inside, "__s", F.col("__cbefore")), gnames, "__k", "__cb",
                       F.col("__s").alias("__cs"))
    else:
        cut = cut.withColumn("__cs", F.lit((1 << 62)))
    keep = (F.col("__cb").isNull() | (F.col("__b") < F.col("__cb"))
            | ((F.col("__b") == F.col("__cb")) & (F.col("__s") <= F.col("__cs"))))
    return rows.join(hint(cut), _group_eq(gnames, "__k"), "left").where(keep).select(*df.columns)


# Largest key set that is broadcast (a few tens of MB of keys).
BROADCAST_MAX_ROWS = 1_000_000


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (file sizes through the plan), or
    None when the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - e.g. Spark Connect
        return None


def first_n(df: DataFrame, n: int, order_by: Sequence[str], ascending: bool = True,
            partition_by: Sequence[str] = (), salt_buckets: int | None = None,
            mantissa_bits: int | None = 12, prefilter: bool | None = None,
            sub_bits: int | None = 12) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (per ``partition_by`` group if given).

    Exact and skew-safe; see module docstring.  ``order_by`` are column names
    and must form a total order (end in a unique key).

    ``prefilter``: True/False forces the histogram cut on or off; None
    (default) uses it when ``n`` exceeds Spark's
    ``windowGroupLimitThreshold``, up to which map tasks keep only their own
    first n rows.  ``mantissa_bits`` / ``sub_bits`` set the resolution of its
    two rounds (``sub_bits=None`` runs round 1 only).
    """
    order = _order(order_by, ascending)
    groups = [F.col(g) for g in partition_by]
    large = n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if prefilter is None:
        prefilter = large
    if prefilter and mantissa_bits and ordinal(df, order_by[0]) is not None:
        df = _cutoff_filter(df, n, order_by[0], ascending, mantissa_bits, partition_by, sub_bits)
    if large:
        return _first_by_range(df, n, order, partition_by)
    # the first level merges sets of map tasks: any assignment gives the same rows
    buckets = _salt_buckets(df, salt_buckets)
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(buckets)))
    w1 = Window.partitionBy(*groups, "__salt").orderBy(*order)
    stage1 = salted.withColumn("__rn", F.row_number().over(w1)).where(F.col("__rn") <= n).drop("__salt")
    if groups:
        w2 = Window.partitionBy(*groups).orderBy(*order)
        out = stage1.withColumn("__rn", F.row_number().over(w2)).where(F.col("__rn") <= n)
    else:
        out = stage1.orderBy(*order).limit(n)
    return out.drop("__rn")


def _first_by_range(df: DataFrame, n: int, order: list[Column], groups: Sequence[str]) -> DataFrame:
    """The first ``n`` rows (per group) by a total order: rows are sorted into
    ranges of groups and order, written once (so that the counts and the rows
    speak of the same ranges), and cut by running counts of the ranges, one row
    per range and group."""
    from kestrel.session import scratch_path
    columns, path = df.columns, scratch_path(df.sparkSession, "ranked")
    ranges = df.repartitionByRange(*[F.col(g) for g in groups], *order).withColumn("__part", F.spark_partition_id())
    schema = ranges.schema
    ranges.write.parquet(path)
    ranges = df.sparkSession.read.schema(schema).parquet(path)
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (ranges.groupBy("__part", *groups).agg(F.count(F.lit(1)).alias("__c"))
              .withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).where(F.col("__before") < n))
    starts = _renamed(counts, groups, "__k", F.col("__part").alias("__kpart"), "__before")
    taken = ranges.join(starts, (F.col("__part") == F.col("__kpart")) & _group_eq(groups, "__k"))
    place = F.row_number().over(Window.partitionBy("__part", *groups).orderBy(*order))
    return (taken.withColumn("__rn", place).where(F.col("__rn") + F.col("__before") <= n).select(*[F.col(f"`{c}`") for c in columns]))


def last_n(df: DataFrame, n: int, order_by: Sequence[str], salt_buckets: int | None = None) -> DataFrame:
    """The last ``n`` rows by ``order_by`` (all columns descending)."""
    return first_n(df, n, order_by, ascending=False, salt_buckets=salt_buckets)


def cap_value(df: DataFrame, column: str, value, keep: int, order_by: Sequence[str],
              keep_nulls: bool = False, salt_buckets: int | None = None) -> DataFrame:
    """Keep every row whose ``column`` differs from ``value`` and only the first
    ``keep`` rows (by ``order_by``) of those equal to it.

    Rows with a NULL ``column`` are dropped unless ``keep_nulls`` (faithful to
    ``!=``).  Rows of other values are never shuffled.
    """
    c = F.col(column)
    others_cond = (c != F.lit(value)) | c.isNull() if keep_nulls else c != F.lit(value)
    others = df.where(others_cond)
    capped = first_n(df.where(c == F.lit(value)), keep, order_by, salt_buckets=salt_buckets)
    return others.unionByName(capped)


def cap_values(df: DataFrame, column: str, keep: int, order_by: Sequence[str],
               salt_buckets: int | None = None) -> DataFrame:
    """Cap every value of ``column`` to its first ``keep`` rows (by order).
    The NULL group is capped like any other value."""
    return first_n(df, keep, order_by, partition_by=[column], salt_buckets=salt_buckets)


def relabel_first(df: DataFrame, column: str, value, n: int, targets: Sequence[str],
                  order_by: Sequence[str], key_cols: Sequence[str], seed: int = 7,
                  salt_buckets: int | None = None) -> DataFrame:
    """The first ``n`` rows with ``column == value``, each given one of
    ``targets`` uniformly (by a seeded hash of ``key_cols``).  Synthetic
    labels: an opt-in class-balancing device, not real data."""
    head = first_n(df.where(F.col(column) == F.lit(value)), n, order_by, salt_buckets=salt_buckets)
    return head.withColumn(column, hash_pick(f"{seed}:pick", targets, *key_cols))


def rebalance(df: DataFrame, column: str, majority, relabel_n: int, tail_n: int,
              targets: Sequence[str], order_by: Sequence[str], key_cols: Sequence[str],
              seed: int = 7, tail_scope: str = "all",
              salt_buckets: int | None = None) -> DataFrame:
    """non-majority rows  UNION ALL  first ``relabel_n`` majority rows relabelled
    UNION ALL  a tail of ``tail_n`` rows.

    ``tail_scope='all'`` (faithful): the last ``tail_n`` rows of the whole
    frame by order, whatever their label, so a row may appear twice.
    ``tail_scope='majority_rest'`` (as documented): the last ``tail_n``
    majority rows that were not relabelled; the three parts are disjoint.
    ``order_by`` must be ascending column names for the tail to be "last".
    """
    c = F.col(column)
    others = df.where(c != F.lit(majority))
    majority_rows = df.where(c == F.lit(majority))
    head = first_n(majority_rows, relabel_n, order_by, salt_buckets=salt_buckets)
    relabelled = head.withColumn(column, hash_pick(f"{seed}:pick", targets, *key_cols))
    if tail_scope == "all":
        tail = last_n(df, tail_n, order_by, salt_buckets)
    elif tail_scope == "majority_rest":
        # last tail_n of (majority minus head) == last tail_n of majority minus
        # head: if they overlap, the tail candidates already hold all the rest.
        # Both sides hold at most tail_n / relabel_n rows.  The head keys are
        # broadcast only up to BROADCAST_MAX_ROWS (a size proven by the
        # parameter); above that AQE decides from the measured size.
        head_keys = head.select(*key_cols)
        if relabel_n <= BROADCAST_MAX_ROWS:
            head_keys = F.broadcast(head_keys)
        tail = last_n(majority_rows, tail_n, order_by, salt_buckets).join(
            head_keys, on=list(key_cols), how="left_anti")
    else:
        raise ValueError(f"unknown tail_scope {tail_scope!r}")
    return others.unionByName(relabelled).unionByName(tail)


def hash_split(df: DataFrame, fractions: Sequence[float], key_cols: Sequence[str],
               seed: int = 7, names: Sequence[str] | None = None,
               out_col: str = "split") -> DataFrame:
    """Assign each row to a split by a seeded hash of its key: reproducible on
    any partitioning (``randomSplit`` is not), no shuffle.  The 60-bit key is
    compared with the edges at full precision."""
    names = list(names) if names else [f"part{i}" for i in range(len(fractions))]
    if len(names) != len(fractions):
        raise ValueError(f"{len(fractions)} fractions but {len(names)} names")
    if not fractions or min(fractions) < 0 or sum(fractions) <= 0:
        raise ValueError("give fractions of at least 0 with a positive sum")
    key, expr, edge = hash_key(seed, *key_cols), F.lit(names[-1]), Fraction(0)
    tot = sum(map(Fraction, fractions))
    cases = []
    for name, frac in zip(names[:-1], fractions[:-1]):
        edge += Fraction(frac) / tot
        cases.append((key < F.lit(int(edge * (1 << KEY_BITS))), F.lit(name)))
    for cond, value in reversed(cases):
        expr = F.when(cond, value).otherwise(expr)
    return df.withColumn(out_col, expr)


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 7) -> list[DataFrame]:
    """``randomSplit`` as in the surveyed code (rows depend on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)
