"""Ledger scan (blank-padded CSV) and analysis."""

import os
import tempfile

import pytest

from kestrel.plans.ledger import Ledger, compare_pairs, top_stages, total_time
from kestrel.sources.files import read_ledger_csv

LINES = [
    "loader, load_csv, Load the log file, 2.5 ",
    "cleaner, cap_label, Cap one label, 1.5 ",
    "trainer, fit_full, Train, 900.0 ",
    "cleaner, dedup_a, Dedup A, 80.0",
    "cleaner, dedup_b, Dedup B, 40.0",
]


def _ledger(spark):
    d = tempfile.mkdtemp(prefix="kestrel-ledger-")
    p = os.path.join(d, "ledger.txt")
    with open(p, "w") as f:
        f.write("\n".join(LINES) + "\n")
    return read_ledger_csv(spark, p)


def test_scan_trims(spark):
    rows = _ledger(spark).collect()
    assert rows[0]["function_name"] == "load_csv" and rows[0]["time_taken"] == 2.5


def test_top_total_pairs(spark):
    led = _ledger(spark)
    top = top_stages(led, n=1).first()
    assert top["function_name"] == "fit_full"
    top_ex = top_stages(led, n=1, exclude_file="trainer").first()
    assert top_ex["function_name"] == "dedup_a"
    tot = total_time(led, exclude_file="trainer").first()
    assert tot["total_time"] == pytest.approx(124.0) and tot["n_stages"] == 4
    pr = compare_pairs(led, [("dedup_a", "dedup_b")]).first()
    assert pr["ratio"] == 2.0 and pr["time_a"] == 80.0


def test_ledger_recorder(spark):
    led = Ledger()
    with led.stage("f", "g", "d"):
        pass
    df = led.frame(spark)
    assert df.count() == 1 and df.first()["time_taken"] >= 0


def test_cached_scope(spark):
    from kestrel.session import cached, clear_caches
    df = spark.range(0, 100)
    with cached(df) as c:
        assert c.count() == 100 and c.is_cached
    assert not df.is_cached
    df.cache().count()
    clear_caches(spark)
    assert spark.range(0, 100).count() == 100


def test_size_for_input(spark):
    from kestrel.session import size_for_input
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        par = spark.sparkContext.defaultParallelism
        assert size_for_input(spark, 10 << 20)["spark.sql.shuffle.partitions"] == str(par)
        big = size_for_input(spark, 100 << 40)                  # 100 TiB
        assert big["spark.sql.shuffle.partitions"] == "204800"   # one per 512 MiB, not capped
        mid = size_for_input(spark, 1 << 40)                    # 1 TiB -> 2048 x 512 MiB
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2048"
        assert mid["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
