"""Plan shape of the registered queries: the scale properties the design
relies on, checked on the physical plans so a change cannot silently lose
them."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
MODEL = {"rf_train_score", "rf_holdout_metrics", "rf_stream_score", "model_save_load_score"}
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
             "ArrowEvalPython")
# Windows without PARTITION BY run only over tables bounded by construction:
# the per-partition counts of global_index, the bucket / sub-bucket histograms
# of a global first_n cut, and a row per file split of with_position.
BOUNDED_ORDER_KEYS = {"__part", "__b", "__s", "__place_file"}
UNPARTITIONED = re.compile(r"windowspecdefinition\((\w+)#\d+L? (?:ASC|DESC)")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in MODEL])
def test_no_forbidden_operators_or_unbounded_windows(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    assert set(UNPARTITIONED.findall(plan)) <= BOUNDED_ORDER_KEYS, name


@pytest.mark.parametrize("name, pushed, schema", [
    ("value_counts_rows", None, "struct<l_returnflag:string>"),
    ("exclude_values", "Not(In(event_type", None),
    ("exclude_equal", "Not(EqualTo(event_type,error))", None),
    ("rate_10s_batch", "IsNotNull(ts)", "struct<ts:timestamp_ntz>"),
    ("binary_metrics_events", None, "struct<event_type:string,value:double>"),
])
def test_filters_and_columns_reach_the_scan(spark, name, pushed, schema):
    plan = _plan(entry.queries()[name](spark, SF))
    if pushed:
        assert pushed in " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))
    if schema:
        assert re.findall(r"ReadSchema: (struct<[^>]*>)", plan) == [schema]


def test_global_cutoff_joins_nothing(spark):
    """A large global top-n is a filter by scalar subqueries, whose histograms
    read the key column alone."""
    from kestrel.operators.sampling import first_n
    ev = spark.read.parquet(f"{SF}/events.parquet")
    plan = _plan(first_n(ev, 50, ["event_id"], ascending=False, prefilter=True))
    assert "Join" not in plan and "Subquery" in plan
    assert "struct<event_id:bigint>" in plan


def _shuffled_rows(spark, df):
    """Rows written to shuffles by the executed plan, by Spark's own metric."""
    df.write.format("noop").mode("overwrite").save()
    df = df.select("*")
    df.collect()
    out, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                out += node.metrics().apply("shuffleRecordsWritten").value()
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    return out


@pytest.mark.parametrize("keep", [20, 1500])
def test_cap_values_shuffles_no_full_table(spark, keep):
    """Small caps are cut in the map tasks, large ones by a broadcast cut."""
    from pyspark.sql import functions as F
    from kestrel.operators.sampling import first_n
    tasks, groups, rows = 6, 5, 60_000
    df = spark.range(0, rows, numPartitions=tasks).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("label"))
    out = first_n(df, keep, ["id"], partition_by=["label"], mantissa_bits=5, sub_bits=5)
    assert out.count() == groups * keep
    # two levels of `keep` rows per task or set of tasks and group, or what the cut
    # leaves plus two histograms
    histograms = 2 * tasks * groups * 500
    assert _shuffled_rows(spark, out) <= min(groups * keep * (tasks + 2), 3 * groups * keep + histograms) < rows


def test_window_check_detects_unpartitioned_windows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert UNPARTITIONED.findall(_plan(bad)) == ["id"]
    good = spark.range(10).withColumn("r", F.row_number().over(
        Window.partitionBy(F.col("id") % 3).orderBy("id")))
    assert UNPARTITIONED.findall(_plan(good)) == []
    assert "__part" in UNPARTITIONED.findall(_plan(entry.queries()["string_index"](spark, SF)))
