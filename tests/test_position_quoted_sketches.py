"""Positions in files, quoted lines, stored sketches, expiring buckets."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.quoted import CORRUPT, corrupt_rows, good_rows, parse_quoted, read_quoted_csv, render_quoted, split_corrupt
from kestrel.operators.position import between_positions, head_by_position, tail_by_position, with_position
from kestrel.operators.sketches import merged_counts, sketch_slices, store_slices
from kestrel.sources.manifest import ManifestTable
from kestrel.streaming.expiring import expiring_bucket_rate
from kestrel.streaming.sources import parquet_table_stream

# ------------------------------------------------------------------ position


@pytest.fixture
def small_splits(spark):
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    for c, v in keep.items():
        spark.conf.set(c, v)


def test_text_positions_for_any_split_of_a_file(spark, tmp_path, small_splits):
    lines = [f"line {i} {'x' * (i * 7 % 90)}" for i in range(3000)]
    (tmp_path / "log.txt").write_text("\n".join(lines) + "\n")
    for size in (1 << 30, 20_000, 3_001):
        small_splits(size)
        rows = with_position(spark.read.text(str(tmp_path)), parquet=False)
        assert {r.position: r.value for r in rows.collect()} == dict(enumerate(lines))
        tail = tail_by_position(spark.read.text(str(tmp_path)), 70, parquet=False).collect()
        assert sorted((r.position, r.value) for r in tail) == list(enumerate(lines))[-70:]


def test_several_files_by_name_and_by_time(spark, tmp_path, small_splits):
    import os
    names = ["b.txt", "a.txt", "c.txt"]
    for k, n in enumerate(names):
        (tmp_path / n).write_text("".join(f"{n} {i}\n" for i in range(200)))
        os.utime(tmp_path / n, (1_000_000 + k, 1_000_000 + k))
    for size in (1 << 30, 700):
        small_splits(size)
        for by_time, order in ((False, sorted(names)), (True, names)):
            want = [f"{n} {i}" for n in order for i in range(200)]
            got = with_position(spark.read.text(str(tmp_path)), parquet=False, by_time=by_time).collect()
            assert [r.value for r in sorted(got, key=lambda r: r.position)] == want
            assert sorted(r.position for r in got) == list(range(600))


def test_parquet_positions(spark, tmp_path):
    df = spark.range(0, 5000, 1, 4).select("id", F.lit("x").alias("file"), F.lit(1).alias("row"))
    df.write.option("parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    got = with_position(read).collect()
    assert sorted(r.position for r in got) == list(range(5000)) and all(r.position == r.id for r in got)
    assert sorted(r.id for r in tail_by_position(read, 1500).collect()) == list(range(3500, 5000))
    assert sorted(r.id for r in head_by_position(read, 3).collect()) == [0, 1, 2]
    assert sorted(r.id for r in between_positions(read, 10, 13).collect()) == [10, 11, 12]
    with pytest.raises(ValueError):
        with_position(read, out_col="id")


def test_position_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "id long").write.parquet(str(tmp_path / "t"))
    assert with_position(spark.read.parquet(str(tmp_path / "t"))).collect() == []


# -------------------------------------------------------------------- quoted

FIELDS = [("a", T.IntegerType()), ("b", T.StringType()), ("c", T.DoubleType())]
LINES = {'1,"x, ""y""",2.5': (1, 'x, "y"', 2.5, False), "2,plain,3": (2, "plain", 3.0, False), "3,short": (3, "short", None, True),
         "4,long,1,2": (4, "long", 1.0, True), "five,bad,1": (None, "bad", 1.0, True), "6,bad,1.2.3": (6, "bad", None, True),
         '7,"",': (7, "", None, False), "8,é中,1e3\r\n": (8, "é中", 1000.0, False)}


def test_quoted_lines(spark):
    df = spark.createDataFrame([(i, line, "k") for i, line in enumerate(LINES)], "id int, line string, b2 string")
    got = {r["id"]: r for r in parse_quoted(df, "line", FIELDS, keep=["id"]).collect()}
    for i, (line, (a, b, c, bad)) in enumerate(LINES.items()):
        r = got[i]
        assert (r["a"], r["b"] or "", r["c"], r[CORRUPT] is not None) == (a, b, c, bad), line
        assert not bad or r[CORRUPT] == line
    # the corrupt mark doesn't depend on which fields are used
    parsed = parse_quoted(df, "line", FIELDS, keep=["id"])
    assert sorted(r["id"] for r in good_rows(parsed).select("id").collect()) == [i for i, v in enumerate(LINES.values()) if not v[3]]
    assert corrupt_rows(parsed, ["id"]).count() == 4
    assert parse_quoted(spark.createDataFrame([(None,)], "line string"), "line", FIELDS).first()[CORRUPT] is None
    with pytest.raises(ValueError):
        parse_quoted(df, "line", [(CORRUPT, T.StringType())])


def test_quoted_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("a,b,c\n" + "\n".join(x.rstrip() for x in LINES) + "\n")
    rows = read_quoted_csv(spark, str(tmp_path / "in"), FIELDS, header=True)
    good = split_corrupt(rows, str(tmp_path / "bad"))
    assert sorted(r["a"] for r in good.select("a").collect()) == [1, 2, 7, 8] and good.columns == ["a", "b", "c"]
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "bad")).collect()) == sorted(x for x, v in LINES.items() if v[3])


def test_render_and_parse_are_inverse(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices('ab,"\' é', k=rng.randrange(1, 9))), i / 7) for i in range(300)]
    lines = render_quoted(spark.createDataFrame(rows, "a int, b string, c double"), ["a", "b", "c"])
    back = parse_quoted(lines, "value", FIELDS)
    assert sorted(tuple(r) for r in back.collect()) == [(*r, None) for r in rows]


# ------------------------------------------------------------------ sketches


def test_sketches_of_slices_merge_to_the_whole(spark, tmp_path):
    df = spark.range(0, 60_000, 1, 8).select(F.concat(F.lit("d"), F.col("id") % 5).alias("day"), "id", (F.col("id") % 900).alias("k"),
                                             F.when(F.col("id") % 3 > 0, F.col("id") / 2).alias("x"))
    t = ManifestTable(spark, str(tmp_path), buckets=4)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    store_slices(t, df.where("day <> 'd4'").mapInArrow(counted, df.schema), "day", ["id", "k", "x"], "first")
    old = reads.value
    store_slices(t, df.where("day = 'd4'").mapInArrow(counted, df.schema), "day", ["id", "k", "x"], "new day")
    assert reads.value - old == 12_000            # the old days are not read again
    got = {r["column_name"]: r for r in merged_counts(t.read()).collect()}
    for c, n in (("id", 60_000), ("k", 900), ("x", 40_001)):
        assert abs(got[c]["n_distinct"] - n) <= 0.03 * n and got[c]["n_rows"] == 60_000
    # a slice stored again replaces its own
    store_slices(t, df.where("day = 'd4'").limit(0).unionByName(df.where("id = 4")), "day", ["id", "k", "x"], "corrected")
    assert {r["column_name"]: r["n_rows"] for r in merged_counts(t.read()).collect()} == {c: 48_001 for c in ("id", "k", "x")}


def test_sketches_of_odd_columns(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, float("nan")), (None, None, None)], "s string, n long, d double")
    got = {r["column_name"]: (r["n_distinct"], r["n_rows"]) for r in merged_counts(sketch_slices(df, "s", ["n", "d", "s"])).collect()}
    assert got == {"n": (1, 3), "d": (3, 3), "s": (2, 3)}
    assert merged_counts(sketch_slices(df.limit(0), "s", ["n"])).collect() == []


# ------------------------------------------------------------------ expiring


def test_state_stays_as_small_as_the_lag(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(12):     # a batch of ten buckets, each three times, some records a bucket late
        rows = [(b,) for b in range(i * 10, i * 10 + 10) for _ in range(3)] + [(None,)] + ([(i * 10 - 1,)] if i else [])
        spark.createDataFrame(rows, "time_stamp int").coalesce(1).write.mode("append").parquet(src)
    agg = expiring_bucket_rate(parquet_table_stream(spark, src, 1), lag=2)
    q = (agg.writeStream.outputMode("append").format("memory").queryName("expiring").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.awaitTermination()
    got = {r["time_stamp"]: r["rate"] for r in spark.table("expiring").collect()}
    assert got == {b: 4 if b % 10 == 9 else 3 for b in range(118)}
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert len(rows) >= 12 and max(rows) <= 10 + 2 and rows[-1] <= 2
    assert dict(spark.table("expiring").dtypes) == {"time_stamp": "int", "rate": "bigint"}
    with pytest.raises(ValueError):
        expiring_bucket_rate(agg, lag=0)
