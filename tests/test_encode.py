"""Dictionary encoding by joins against plain counting."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from kestrel.operators import encode
from kestrel.operators.encode import encode_rows, fit_dictionaries, load_dictionaries, load_encoded, train_encoded


def frame(spark, rows, ddl="id long, a string, b int, value string, idx string"):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ddl)


def places(values):
    counts = Counter(str(v) for v in values if v is not None)
    return {v: i for i, (v, _) in enumerate(sorted(counts.items(), key=lambda t: (-t[1], t[0])))}


ROWS = [(i, None if i % 11 == 0 else f"v{i % 37 if i % 3 else 0}", None if i % 13 == 0 else i * i % 101) for i in range(2000)]
LONG = "long " * 1000


@pytest.mark.parametrize("hot_rows", [0, 1, 5, 10_000])
def test_indexes_whichever_way_rows_meet_the_dictionary(spark, tmp_path, hot_rows):
    rows = [*ROWS, (2000, LONG, 7), (2001, LONG, 7), (2002, "", 7)]
    known = fit_dictionaries(frame(spark, rows), ["a", "b"], str(tmp_path))
    a, b = places(r[1] for r in rows), places(r[2] for r in rows)
    assert known.columns == ("a", "b") and known.sizes == (len(a), len(b))
    new = [*rows, (3000, "unseen", -5), (3001, None, None)]
    out = encode_rows(frame(spark, new), load_dictionaries(spark, str(tmp_path)), hot_rows=hot_rows)
    assert out.columns == ["id", "a", "b", "value", "idx", "a_index", "b_index"]
    assert {r.id: (r.a_index, r.b_index) for r in out.collect()} == {
        i: (float(a.get(x, len(a))), float(b.get(str(y), len(b)))) for i, x, y in new}


@pytest.mark.parametrize("unseen,ids", [("null", [1, 2, 3]), ("skip", [1])])
def test_unseen_values(spark, tmp_path, unseen, ids):
    known = fit_dictionaries(frame(spark, [(0, "p", 1), (0, "q", 1), (0, "q", 1)]), ["a"], str(tmp_path))
    out = encode_rows(frame(spark, [(1, "p", 1), (2, "other", 1), (3, None, 1)]), known, unseen=unseen).collect()
    assert sorted(r.id for r in out) == ids
    assert {r.id: r.a_index for r in out} == {i: (1.0 if i == 1 else None) for i in ids}


def test_dictionary_rows_stay_off_the_driver(spark, tmp_path):
    """Beyond the hot values the plan shuffles; a hot value's rows are dealt by salt."""
    rows = frame(spark, [(i, "hot" if i % 3 else f"rare{i}", 1) for i in range(3000)])
    known = fit_dictionaries(rows, ["a"], str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = encode_rows(rows, known, hot_rows=1)
        per_task = out.where("a = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in per_task) <= 2 * 2000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
        small = encode_rows(rows, known, hot_rows=5000)
        assert "SortMergeJoin" not in small._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_and_all_null(spark, tmp_path):
    known = fit_dictionaries(frame(spark, []), ["a", "b"], str(tmp_path / "e"))
    assert known.sizes == (0, 0)
    assert [r.a_index for r in encode_rows(frame(spark, [(1, "x", 1), (2, None, 1)]), known).collect()] == [0.0, 0.0]
    known = fit_dictionaries(frame(spark, [(1, None, 4)]), ["a", "b"], str(tmp_path / "n"))
    assert known.sizes == (0, 1)
    assert encode_rows(frame(spark, []), known).collect() == []


def test_clashing_names_are_refused(spark, tmp_path):
    rows = frame(spark, ROWS[:5])
    known = fit_dictionaries(rows, ["a"], str(tmp_path))
    with pytest.raises(ValueError):
        encode_rows(rows.withColumn("a_index", F.lit(1)), known)
    with pytest.raises(ValueError):
        encode_rows(rows.withColumn(f"{encode.WORK}key", F.lit(1)), known)
    with pytest.raises(ValueError):
        encode_rows(rows, known, unseen="drop")


def test_same_indexes_as_the_ml_stage(spark, tmp_path):
    from pyspark.ml.feature import StringIndexer
    rows = frame(spark, ROWS).where("a is not null")
    known = fit_dictionaries(rows, ["a"], str(tmp_path))
    both = StringIndexer(inputCol="a", outputCol="want").fit(rows).transform(encode_rows(rows, known, hot_rows=3))
    assert both.where("want <> a_index").isEmpty()


def test_forest_learns_a_nominal_column_that_no_order_separates(spark, tmp_path):
    """Labels alternate along the frequency ranks, so only nominal splits learn
    them with few bins; scoring uses the saved dictionary, new values included."""
    rows = spark.createDataFrame([(i, f"v{k:02d}", float(i % 5), "odd" if k % 2 else "even")
                                  for k in range(40) for i in range(60 - k)], "id long, kind string, noise double, category string")
    train_encoded(rows, str(tmp_path), ["kind"], exclude=["id"])
    model = load_encoded(spark, str(tmp_path))
    out = model.predict(rows.withColumnRenamed("category", "truth"))
    assert out.columns == ["id", "kind", "noise", "truth", "category"]
    assert out.where("truth <> category").isEmpty() and out.count() == rows.count()
    new = model.predict(spark.createDataFrame([(1, "never seen", 1.0), (2, None, 1.0)], "id long, kind string, noise double"))
    assert {r.id: r.category in ("odd", "even") for r in new.collect()} == {1: True, 2: True}


def test_long_dictionaries_enter_as_ranks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"k{i % 300}", "hi" if i % 300 < 150 else "lo") for i in range(1500)] +
                                 [(i, f"k{i % 150}", "hi") for i in range(1500, 3000)], "id long, key string, category string")
    model = train_encoded(rows, str(tmp_path), ["key"], exclude=["id"], max_nominal=32)
    assert model.predict(rows.withColumnRenamed("category", "truth")).where("truth <> category").isEmpty()
