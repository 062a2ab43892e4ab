"""Greedy time buckets: a bucket starts with the first record that is more than
``gap`` after the start of the bucket before it.

Unlike wall-aligned windows, every start depends on all starts before it, so a
plain window function would need the whole log in one ordered task.  Here the
distinct times are range-partitioned, and each range becomes a *jump function*:
given the last start before the range, it tells the last start inside it and
how many buckets began.  The function is a short table, because the last start
lies before the range and so only records within one gap of its first record
(and the next one) can be the first start inside.  Functions of neighbouring
ranges are composed ``FAN_IN`` at a time until one is left; then the true
starts are handed down the same tree, and every range numbers its own times.

Records of equal time are counted before anything is sorted, so a hot second
is one row.  A task holds the distinct times of a range (8 bytes each) or the
tables of ``FAN_IN`` ranges; a table has at most the distinct times of one gap.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.times import ntz_as_utc, utc_as_ntz
from kestrel.session import scratch_path

FAN_IN = 32

_TABLE = pa.schema([("part", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("entry", pa.list_(pa.int64())),
                    ("leaves", pa.list_(pa.int64())), ("began", pa.list_(pa.int64()))])
_TABLE_DDL = "part long, first long, last long, entry array<long>, leaves array<long>, began array<long>"
_STATE = pa.schema([("part", pa.int64()), ("start", pa.int64()), ("number", pa.int64())])
_STATE_DDL = "part long, start long, number long"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path, schema = scratch_path(df.sparkSession, name), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def walk(times: np.ndarray, at: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """From each position of ``at`` (a start) in the sorted ``times``: the
    position of the last start, and the starts passed (the first included)."""
    at, began = at.copy(), np.ones(len(at), np.int64)
    moving = np.arange(len(at))
    while len(moving):
        following = np.searchsorted(times, times[at[moving]] + gap, side="right")
        moving, following = moving[following < len(times)], following[following < len(times)]
        at[moving] = following
        began[moving] += 1
    return at, began


def _entries(times: np.ndarray, first: int, gap: int) -> np.ndarray:
    """The times at which the first start of a range can lie: those within one
    gap of its first time, and the next one."""
    return times[:int(np.searchsorted(times, first + gap, side="right")) + 1]


def jump_table(times: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    entry = _entries(times, int(times[0]), gap)
    at, began = walk(times, np.arange(len(entry)), gap)
    return entry, times[at], began


def apply(table: dict, start: np.ndarray, number: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Carry (last start, buckets so far) over a range."""
    inside = start + gap < table["last"]        # else no bucket begins in the range
    at = np.searchsorted(table["entry"], start[inside] + gap, side="right")
    start, number = start.copy(), number.copy()
    start[inside] = table["leaves"][at]
    number[inside] += table["began"][at]
    return start, number


def compose(tables: list[dict], gap: int) -> dict:
    """The jump function of neighbouring ranges, in order."""
    first = tables[0]["first"]
    entry = _entries(np.concatenate([t["entry"] for t in tables]), first, gap)
    start, number, done = np.empty(len(entry), np.int64), np.zeros(len(entry), np.int64), 0
    for i, t in enumerate(tables):
        if done:
            start[:done], number[:done] = apply(t, start[:done], number[:done], gap)
        own = min(len(t["entry"]), len(entry) - done)
        start[done:done + own], number[done:done + own] = t["leaves"][:own], t["began"][:own]
        done += own
    return {"first": first, "last": tables[-1]["last"], "entry": entry, "leaves": start, "began": number}


def _read(table: pa.Table) -> list[dict]:
    table = table.sort_by("part")
    lists = {c: [np.asarray(v.values) for v in table.column(c)] for c in ("entry", "leaves", "began")}
    rows = zip(table.column("part").to_pylist(), table.column("first").to_pylist(), table.column("last").to_pylist())
    return [{"part": p, "first": a, "last": b} | {c: lists[c][i] for c in lists} for i, (p, a, b) in enumerate(rows)]


def _row(part: int, t: dict) -> pa.RecordBatch:
    lists = [pa.array([t[c]], pa.list_(pa.int64())) for c in ("entry", "leaves", "began")]
    return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in (part, t["first"], t["last"])], *lists], schema=_TABLE)


def _range_tables(gap: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        times = np.sort(np.asarray(table.column("t")))
        entry, leaves, began = jump_table(times, gap)
        t = {"first": int(times[0]), "last": int(times[-1]), "entry": entry, "leaves": leaves, "began": began}
        return pa.Table.from_batches([_row(table.column("part")[0].as_py(), t)])
    return run


def _composed(gap: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        tables = _read(table)
        return pa.Table.from_batches([_row(tables[0]["part"] // FAN_IN, compose(tables, gap))])
    return run


def _handed_down(gap: int) -> Callable:
    def run(tables: pa.Table, states: pa.Table) -> pa.Table:
        start, number = (np.asarray(states.column(c))[:1] for c in ("start", "number"))
        out = []
        for t in _read(tables):
            out.append((t["part"], int(start[0]), int(number[0])))
            start, number = apply(t, start, number, gap)
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], schema=_STATE)
    return run


def _numbered(gap: int) -> Callable:
    def run(times: pa.Table, states: pa.Table) -> pa.Table:
        t = times.sort_by("t")
        at, n = np.asarray(t.column("t")), np.asarray(t.column("n"))
        before, number = states.column("start")[0].as_py(), states.column("number")[0].as_py()
        first = int(np.searchsorted(at, before + gap, side="right"))
        starts = []
        while first < len(at):
            starts.append(first)
            first = int(np.searchsorted(at, at[first] + gap, side="right"))
        which = np.searchsorted(np.array(starts, np.int64), np.arange(len(at)), side="right")
        start = np.concatenate([[before], at[starts]]).astype(np.int64)[which]
        return pa.table([t.column("t"), pa.array(n), pa.array(number + which), pa.array(start)],
                        names=["t", "n", "bucket", "start"])
    return run


def _micros(df: DataFrame, ts_col: str):
    ts = F.col(ts_col)
    return F.unix_micros(ntz_as_utc(ts) if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType) else ts)


def bucketed_times(df: DataFrame, ts_col: str, gap_seconds: float = 10.0, origin_micros: int | None = None) -> DataFrame:
    """(t, n, bucket, start): each distinct time (microseconds), its rows, the
    number of its bucket (from 1) and the bucket's first time.  Rows without
    time belong to no bucket.  With ``origin_micros`` the first bucket starts
    there (records before it belong to it too), without it at the first record."""
    gap = round(gap_seconds * 1_000_000)
    times = df.select(_micros(df, ts_col).alias("t")).where("t is not null").groupBy("t").agg(F.count("*").alias("n"))
    ranges = _kept(times.repartitionByRange("t").withColumn("part", F.spark_partition_id().cast("long")), "times")
    levels = [_kept(ranges.groupBy("part").applyInArrow(_range_tables(gap), _TABLE_DDL), "jumps")]
    group = F.floor(F.col("part") / FAN_IN)
    while (high := levels[-1].agg(F.max("part")).first()[0]) is not None and high > 0:
        levels.append(_kept(levels[-1].groupBy(group.alias("g")).applyInArrow(_composed(gap), _TABLE_DDL), "jumps"))
    # the state before the first range: the origin, or a start just out of reach
    states = levels[-1].select("part", *([F.lit(origin_micros).cast("long").alias("start"), F.lit(1).cast("long").alias("number")]
                                         if origin_micros is not None else
                                         [(F.col("first") - gap - 1).alias("start"), F.lit(0).cast("long").alias("number")]))
    for tables in levels[-2::-1]:
        states = _kept(tables.groupBy(group.alias("g")).cogroup(states.groupBy(F.col("part").alias("g")))
                       .applyInArrow(_handed_down(gap), _STATE_DDL), "starts")
    return (ranges.groupBy("part").cogroup(states.groupBy("part"))
            .applyInArrow(_numbered(gap), "t long, n long, bucket long, start long"))


def greedy_bucket_rate(df: DataFrame, ts_col: str, gap_seconds: float = 10.0, origin_micros: int | None = None) -> DataFrame:
    """(bucket, start, rate): records per greedy bucket, numbered from 1; a
    bucket without records (only the first, with an origin) has no row."""
    ntz = isinstance(df.schema[ts_col].dataType, T.TimestampNTZType)
    start = F.timestamp_micros("start")
    return (bucketed_times(df, ts_col, gap_seconds, origin_micros).groupBy("bucket", "start").agg(F.sum("n").alias("rate"))
            .withColumn("start", utc_as_ntz(start) if ntz else start))


def with_greedy_bucket(df: DataFrame, ts_col: str, gap_seconds: float = 10.0, origin_micros: int | None = None,
                       out_col: str = "bucket") -> DataFrame:
    """``df`` with each row's bucket number (null without a time)."""
    times = bucketed_times(df, ts_col, gap_seconds, origin_micros).select(F.col("t").alias("__greedy_t"), F.col("bucket").alias("__greedy_b"))
    # a row without time must not meet the others of its kind in one task: they match nothing either way
    known = df.where(F.col(ts_col).isNotNull()).withColumn("__greedy_t", _micros(df, ts_col)).join(times, "__greedy_t")
    none = df.where(F.col(ts_col).isNull()).withColumn(out_col, F.lit(None).cast("long"))
    return known.withColumn(out_col, F.col("__greedy_b")).drop("__greedy_t", "__greedy_b").unionByName(none)
