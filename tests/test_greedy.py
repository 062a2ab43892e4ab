"""Greedy buckets against a plain loop."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import greedy

UTC = dt.timezone.utc
T0 = dt.datetime(2024, 1, 1, tzinfo=UTC)


def table(spark, micros):
    rows = [(i, None if m is None else m) for i, m in enumerate(micros)]
    return spark.createDataFrame(rows, "id long, m long").select("id", F.timestamp_micros("m").alias("ts"), F.lit(1).alias("start"))


def loop(micros, gap, origin=None):
    out, start, number = {}, origin, 0 if origin is None else 1
    for m in sorted(m for m in micros if m is not None):
        if start is None or m > start + gap:
            start, number = m, number + 1
        out[number] = (start, out.get(number, (0, 0))[1] + 1)
    return out


def rates(spark, micros, gap, **kw):
    rows = greedy.greedy_bucket_rate(table(spark, micros), "ts", gap / 1e6, **kw).select("bucket", F.unix_micros("start").alias("s"), "rate")
    return {r.bucket: (r.s, r.rate) for r in rows.collect()}


def dense(seed, n, span):
    rng = random.Random(seed)
    return [rng.randrange(span) for _ in range(n)]


@pytest.mark.parametrize("seed,n,span,gap", [(1, 3000, 10**9, 10**7), (2, 3000, 10**6, 10**5), (3, 400, 10**12, 10**7), (4, 2000, 5000, 10**7)])
def test_matches_a_loop(spark, seed, n, span, gap):
    micros = dense(seed, n, span)
    assert rates(spark, micros, gap) == loop(micros, gap)


def test_many_small_ranges(spark, monkeypatch):
    """Ranges far narrower than a gap, and a tree of several levels."""
    monkeypatch.setattr(greedy, "FAN_IN", 2)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed, span in ((5, 10**6), (6, 10**8)):
            micros = dense(seed, 300, span)
            for gap in (span // 1000, span // 20, span // 3):
                assert rates(spark, micros, gap) == loop(micros, gap)
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)


def test_composition_of_any_split_is_the_whole():
    rng = np.random.default_rng(3)
    for _ in range(200):
        times = np.unique(rng.integers(0, rng.integers(20, 3000), rng.integers(1, 200)))
        gap = int(rng.integers(1, 200))
        cuts = np.sort(rng.choice(len(times), size=min(len(times), int(rng.integers(0, 9))), replace=False))
        tables = [{"first": int(p[0]), "last": int(p[-1])} | dict(zip(("entry", "leaves", "began"), greedy.jump_table(p, gap)))
                  for p in np.split(times, cuts) if len(p)]
        whole = greedy.compose(tables, gap)
        assert [x.tolist() for x in (whole["entry"], whole["leaves"], whole["began"])] == [x.tolist() for x in greedy.jump_table(times, gap)]


def test_hot_second_nulls_and_ties(spark):
    micros = [7_000_000] * 5000 + [None] * 50 + [7_000_001, 17_000_000, 17_000_001, 27_000_000, 27_000_002]
    got = rates(spark, micros, 10**7)
    assert got == loop(micros, 10**7) == {1: (7_000_000, 5002), 2: (17_000_001, 2), 3: (27_000_002, 1)}


def test_exactly_one_gap_later_stays(spark):
    assert rates(spark, [0, 10, 20, 21], 10) == {1: (0, 2), 2: (20, 2)}


def test_origin(spark):
    micros = [50, 105, 111, 130]
    assert rates(spark, micros, 10, origin_micros=100) == loop(micros, 10, 100) == {1: (100, 2), 2: (111, 1), 3: (130, 1)}
    assert rates(spark, [50, 500], 10, origin_micros=0) == {2: (50, 1), 3: (500, 1)}


def test_empty_table(spark):
    assert rates(spark, [], 10) == {} and rates(spark, [None, None], 10) == {}


def test_rows_keep_their_columns(spark):
    micros = dense(8, 500, 10**6) + [None, None]
    rows = greedy.with_greedy_bucket(table(spark, micros), "ts", 0.05)
    assert rows.columns == ["id", "ts", "start", "bucket"]
    number = {}
    start, k = None, 0
    for m in sorted(set(m for m in micros if m is not None)):
        if start is None or m > start + 50_000:
            start, k = m, k + 1
        number[m] = k
    assert {r.id: r.bucket for r in rows.collect()} == {i: number.get(m) for i, m in enumerate(micros)}


def test_no_window_and_no_single_partition(spark):
    plan = greedy.bucketed_times(table(spark, dense(9, 50, 1000)), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
