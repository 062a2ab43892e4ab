"""Model training and scoring beyond what the SQL twins state."""

import pytest
from pyspark.sql import functions as F

from kestrel.operators.filters import invalid_feature_counts
from kestrel.operators.ml import feature_columns, predict, train_model

ROWS = 600


def frame(spark):
    """Columns whose names end like working columns, NULL and NaN features, NULL labels."""
    i = F.col("id")
    return spark.range(0, ROWS, numPartitions=4).select(
        "id", (i % 7).cast("double").alias("is_new"), F.when(i % 10 != 3, (i % 5).cast("double")).alias("y"),
        F.when(i % 20 == 4, F.lit(float("nan"))).otherwise((i % 3).cast("double")).alias("features"),
        F.concat(F.lit("b"), i % 4).alias("brand_new"), (i % 2 == 0).alias("prediction"),
        F.when(i % 50 != 7, F.when(i % 7 < 3, "attack").otherwise("normal")).alias("category"))


def fit(spark, **kw):
    return train_model(frame(spark), exclude=["id", "prediction"], categorical=["brand_new"], use_categoricals=True, **kw)


def test_columns_keep_their_names(spark):
    df = frame(spark)
    out = predict(fit(spark), df)
    assert out.columns == [c for c in df.columns if c != "category"] + ["category"]
    assert {r["category"] for r in out.select("category").distinct().collect()} <= {"attack", "normal"}


@pytest.mark.parametrize("invalid, rows, nulls", [("skip", 510, 0), ("keep", ROWS, 90), ("impute", ROWS, 0)])
def test_invalid_features(spark, invalid, rows, nulls):
    model = fit(spark, invalid=invalid)
    seen = invalid_feature_counts(frame(spark), feature_columns(model.stages), "category").first()
    assert (seen["n_rows"], seen["n_null_label"], seen["n_invalid"]) == (ROWS, 12, 90)
    out = predict(model, frame(spark), invalid=invalid).persist()
    assert out.count() == rows and out.where("category is null").count() == nulls
    # the caller's values are as they were
    assert out.where("y is null").count() == (60 if invalid != "skip" else 0)


def test_input_is_read_once_and_reserved_names_are_refused(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = frame(spark)
    train_model(df.mapInArrow(count, df.schema).repartition(3, "id"), exclude=["id", "prediction"], categorical=[])
    assert reads.value == ROWS
    with pytest.raises(ValueError):
        predict(fit(spark), df.withColumn("__ml_features", F.lit(1)))
    with pytest.raises(ValueError):
        fit(spark, invalid="drop")


def test_fixed_partitions_fix_the_model(spark):
    df = frame(spark).drop("brand_new")
    a, b = (train_model(d.orderBy("id"), exclude=["id", "prediction"], partitions=1) for d in (df, df.coalesce(1)))
    one, two = ({r["id"]: r["category"] for r in predict(m, df).collect()} for m in (a, b))
    assert len(one) == len(two) == 510


def test_batch_score_aligns_with_the_table(spark):
    from kestrel.plans.training import aligned
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    table = spark.createDataFrame([], "y string, z double, x long").schema
    assert aligned(df, table).collect()[0].asDict() == {"y": "a", "z": None, "x": 1}
    with pytest.raises(ValueError):
        aligned(df.withColumn("w", F.lit(1)), table)
