"""Hot-key inputs (one label holds a third of all rows, thousands of labels
are rare) against pandas brute force, on the paths taken at scale: the
rare-value anti join as a sort-merge join with AQE's skew split, not a
broadcast."""

import random

import pandas as pd
import pytest

from kestrel.operators.dedup import drop_duplicates
from kestrel.operators.filters import drop_rare_values
from kestrel.operators.ml import string_index_table
from kestrel.operators.stats import value_counts


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(11)
    rows = []
    for i in range(30000):
        r = rng.random()
        if r < 0.34:
            lab = "hot"
        elif r < 0.40:
            lab = None
        elif r < 0.55:
            lab = f"rare{rng.randrange(3000)}"           # mostly 1-4 rows each
        else:
            lab = f"mid{rng.randrange(40)}"
        rows.append((i % 9000 if lab == "hot" else i, lab))  # hot rows repeat exactly
    pdf = pd.DataFrame(rows, columns=["k", "label"])
    return spark.createDataFrame(rows, "k long, label string").repartition(7), pdf


@pytest.fixture
def no_broadcast_skew_split(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_drop_rare_values_sort_merge_path(spark, skewed, no_broadcast_skew_split):
    df, pdf = skewed
    out = drop_rare_values(df, "label", min_count=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    smj = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert smj and all("__salt" in line for line in smj), smj   # keys (label, salt)
    counts = pdf["label"].value_counts()
    keep = set(counts[counts >= 5].index)
    exp = pdf[pdf["label"].isin(keep)]
    got = out.toPandas()
    assert len(got) == len(exp)
    assert got["label"].value_counts().to_dict() == exp["label"].value_counts().to_dict()


def test_value_counts_and_string_index(spark, skewed):
    df, pdf = skewed
    got = {r["label"]: r["n"] for r in value_counts(df, "label", count_rows=True).collect()}
    exp = pdf["label"].value_counts(dropna=False).to_dict()
    assert got == {(None if pd.isna(k) else k): v for k, v in exp.items()}
    idx = {r["label"]: r["idx"] for r in string_index_table(df, "label").collect()}
    counts = pdf["label"].value_counts()
    order = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    assert idx == {lab: float(i) for i, (lab, _) in enumerate(order)}


def test_dedup_with_hot_duplicates(spark, skewed):
    df, pdf = skewed
    assert drop_duplicates(df).count() == len(pdf.drop_duplicates())


def test_drop_rare_values_share_and_nulls(spark, skewed, no_broadcast_skew_split):
    df, pdf = skewed
    counts = pdf["label"].value_counts(dropna=False)
    share = 0.002                                   # threshold 60 rows of 30000
    rare = {k for k, v in counts.items() if v < share * len(pdf)}
    got = drop_rare_values(df, "label", min_share=share, keep_nulls=True).toPandas()
    exp = pdf[pdf["label"].isna() | ~pdf["label"].isin(rare)]
    assert len(got) == len(exp) and got["label"].isna().sum() == pdf["label"].isna().sum()
    assert list(got.columns) == ["k", "label"]


def test_heavy_set_bound_is_checked(spark, skewed):
    df, _ = skewed
    with pytest.raises(ValueError):
        drop_rare_values(df, "label", min_count=5, max_heavy=10**9)


@pytest.mark.parametrize("kind", ["ties", "prefix"])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_large_heads_spread_ties_over_ranges(spark, kind, groups):
    """A third of all rows tie on the first order column, or share its first
    bytes: the result is exact, and no range holds much more than its share."""
    from pyspark.sql import functions as F

    from kestrel.operators import sampling
    rows = 24_000
    i = F.col("id")
    tie = F.when(i % 3 == 0, F.lit("http://same.example/")).otherwise(F.concat(F.lit("http://x.example/"), i % 977))
    df = spark.range(0, rows, 1, 6).select(
        "id", (tie if kind == "ties" else F.concat(F.lit("http://long.example/"), F.lpad(F.xxhash64("id").cast("string"), 25, "0"))).alias("url"),
        F.when(i % 50 < 40, "hot").when(i % 50 < 45, F.concat(F.lit("g"), i % 7)).alias("g"))
    made = []
    import kestrel.session as session
    old = session.scratch_path
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.scratch_path = lambda s, name: made.append(old(s, name)) or made[-1]
    try:
        got = sampling.first_n(df, 1500, ["url", "id"], partition_by=groups)
        ids = sorted(r["id"] for r in got.select("id").collect())
    finally:
        session.scratch_path = old
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    pdf = df.toPandas().sort_values(["url", "id"])
    want = pdf.groupby("g", dropna=False).head(1500) if groups else pdf.head(1500)
    assert ids == sorted(want["id"]) and got.columns == df.columns
    sizes = [r["count"] for r in spark.read.parquet(made[0]).groupBy("__part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 4 * sum(sizes) / len(sizes)
