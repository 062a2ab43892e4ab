"""Binary metrics edge cases and the string index twin."""

import pytest

from kestrel.operators.metrics import binary_metrics
from kestrel.operators.ml import string_index_table


def _m(spark, pairs):
    df = spark.createDataFrame(pairs, "prediction double, label double")
    return binary_metrics(df, "prediction", "label", negative=0.0).first().asDict()


def test_mixed(spark):
    m = _m(spark, [(1.0, 1.0), (2.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)])
    assert (m["tp"], m["fp"], m["tn"], m["fn"]) == (2, 1, 2, 1)
    assert m["precision"] == pytest.approx(2 / 3, abs=1e-6)
    assert m["recall"] == pytest.approx(2 / 3, abs=1e-6)
    assert m["false_positive_rate"] == pytest.approx(1 / 3, abs=1e-6)
    assert m["accuracy"] == pytest.approx(4 / 6, abs=1e-6)


def test_no_positive_prediction(spark):
    m = _m(spark, [(0.0, 1.0), (0.0, 0.0)])
    assert m["precision"] == 0.0 and m["recall"] == 0.0


def test_no_positive_label(spark):
    m = _m(spark, [(1.0, 0.0), (0.0, 0.0)])
    assert m["recall"] is None and m["false_positive_rate"] == 0.5


def test_every_label_positive(spark):
    m = _m(spark, [(1.0, 1.0), (0.0, 3.0)])
    assert m["false_positive_rate"] is None and m["recall"] == 0.5


def test_null_pairs_ignored(spark):
    m = _m(spark, [(1.0, 1.0), (None, 1.0), (1.0, None)])
    assert m["tp"] == 1 and m["accuracy"] == 1.0


def test_string_index_matches_stringindexer(spark):
    from pyspark.ml.feature import StringIndexer
    df = spark.createDataFrame([(x,) for x in "bbaacccd"], "s string")
    ours = {r["s"]: r["idx"] for r in string_index_table(df, "s").collect()}
    model = StringIndexer(inputCol="s", outputCol="i").fit(df)
    theirs = {lab: float(i) for i, lab in enumerate(model.labels)}
    assert ours == theirs


def test_global_index_many_partitions(spark):
    from pyspark.sql import functions as F
    from kestrel.operators.ml import global_index
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    got = global_index(df, [F.col("k").desc()]).toPandas().sort_values("idx")
    assert list(got["idx"]) == list(range(5000))
    assert list(got["k"]) == sorted(got["k"], reverse=True)


def test_string_index_high_cardinality(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 3000).select((F.col("id") % 1200).cast("string").alias("s"))
    got = string_index_table(df, "s").toPandas()
    exp = (df.toPandas().value_counts("s").rename("n").reset_index()
           .sort_values(["n", "s"], ascending=[False, True]).reset_index(drop=True))
    got = got.sort_values("idx").reset_index(drop=True)
    assert list(got["s"]) == list(exp["s"]) and list(got["idx"]) == [float(i) for i in range(1200)]


def test_global_index_without_exchange_reuse(spark):
    """Offsets must fit the rows even when the sort is not shared between the
    counts and the rows (no AQE stage cache, no exchange reuse)."""
    from pyspark.sql import functions as F
    from kestrel.operators.ml import global_index
    keys = ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "false")
        df = (spark.range(0, 20000).repartition(7)
              .groupBy((F.col("id") % 3000).alias("k")).agg(F.count("id").alias("n")))
        got = global_index(df, [F.col("n").desc(), F.col("k").asc()]).toPandas()
        got = got.sort_values("idx")
        assert list(got["idx"]) == list(range(3000))
        expected = sorted(zip(got["n"], got["k"]), key=lambda t: (-t[0], t[1]))
        assert list(zip(got["n"], got["k"])) == expected
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_holdout_hash_split_scores_exactly_the_valid_side(spark):
    from pyspark.sql import functions as F
    from kestrel.operators.ml import holdout_metrics
    from kestrel.operators.sampling import hash_split
    df = spark.range(0, 600).select(
        "id", (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 5).cast("double").alias("y"),
        F.when(F.col("id") % 7 < 3, "attack").otherwise("normal").alias("category"))
    m = holdout_metrics(df, negative="normal", split_keys=["id"], exclude=["id"]).first()
    valid = hash_split(df, [0.75, 0.25], ["id"], seed=7, names=["t", "v"]).where(
        F.col("split") == "v").count()
    assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == valid
    again = holdout_metrics(df.repartition(5), negative="normal", split_keys=["id"],
                            exclude=["id"]).first()
    assert again["tp"] + again["fp"] + again["tn"] + again["fn"] == valid


def test_categoricals_wider_than_default_bins(spark):
    """45 service values (+1 kept for unseen ones) exceed the default 32 bins;
    the pipeline sizes maxBins and scores an unseen value."""
    from kestrel.operators.ml import predict, train_model
    rows = [(float(i % 7), f"svc{i % 45}", "tcp", "SF", "a" if i % 3 else "b") for i in range(2000)]
    schema = "duration double, service string, protocol_type string, flag string, category string"
    model = train_model(spark.createDataFrame(rows, schema), label_col="category",
                        use_categoricals=True)
    assert model.stages[-1].getMaxBins() >= 46
    new = spark.createDataFrame([(1.0, "never_seen", "tcp", "SF", None)], schema).drop("category")
    assert {r["category"] for r in predict(model, new).collect()} <= {"a", "b"}
