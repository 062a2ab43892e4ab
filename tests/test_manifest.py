"""Commits: whole or not at all, once, and in few folders."""

import os

import pytest
from pyspark.sql import functions as F

from kestrel.sources.manifest import CommitConflict, ManifestTable
from kestrel.streaming.rate import bucket_rate
from kestrel.streaming.sinks import run_append_commits, run_update_commits
from kestrel.streaming.sources import parquet_table_stream


def rows(spark, ids, value="x"):
    return spark.createDataFrame([(i, f"{value}{i}") for i in ids], "id long, v string")


def ids(table):
    return sorted(r["id"] for r in table.read().collect())


def test_runs_count_once(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.append(rows(spark, [1, 2]), "a") and not t.append(rows(spark, [1, 2]), "a")
    assert t.append(rows(spark, [3]), "s", 4) and not t.append(rows(spark, [9]), "s", 3) and t.append(rows(spark, [4]), "s", 5)
    assert ids(ManifestTable(spark, str(tmp_path))) == [1, 2, 3, 4]
    assert t.done("a") and t.done("s", 5) and not t.done("s", 6)


def test_a_run_that_dies_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    t = ManifestTable(spark, str(tmp_path))
    t.append(rows(spark, [1]), "a")
    fails = F.when(F.col("id") > 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="lost"):
        t.append(rows(spark, [2, 3]).withColumn("id", fails.cast("long")), "b")
    # killed between the data and the commit
    with monkeypatch.context() as m:
        m.setattr(ManifestTable, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            t.append(rows(spark, [2, 3]), "b")
    # killed while it wrote the manifest
    with open(tmp_path / "_manifest" / "000000000002.json", "w") as f:
        f.write('{"version": 2, "parts": [')
    assert ids(t) == [1]
    assert t.append(rows(spark, [2, 3]), "b") and ids(t) == [1, 2, 3]
    assert t.vacuum(older_than_seconds=3600) == 0 and t.vacuum(older_than_seconds=-5) == 1 and ids(t) == [1, 2, 3]


def test_two_writers_one_commit(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path))
    t.append(rows(spark, [1]))
    before = t._load()
    t.append(rows(spark, [2]))
    with pytest.raises(CommitConflict):
        t._commit(before, {}, [], [], None)
    assert ids(t) == [1, 2]


def test_other_columns_are_refused(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path))
    t.append(rows(spark, [1]))
    with pytest.raises(ValueError, match="holds"):
        t.append(rows(spark, [2]).withColumn("more", F.lit(1)))


def test_folders_grow_with_the_logarithm(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path), fan=3)
    for i in range(20):
        t.append(rows(spark, [i]), "s", i)
        assert t.folders() <= 2 * 3
    assert ids(t) == list(range(20)) and t.folders() == 4      # 20 = 2 * 9 + 0 * 3 + 2
    on_disk = len(os.listdir(tmp_path / "data"))
    assert on_disk <= t.folders() + 2 * 3 and len(os.listdir(tmp_path / "_manifest")) <= 2 * 5


def test_unseen_rows_only(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path), buckets=4, fan=3)
    assert t.append_unseen(rows(spark, [1, 2, 2, 2]), ["id"], "a") and ids(t) == [1, 2]
    assert not t.append_unseen(rows(spark, [7]), ["id"], "a")
    assert t.append_unseen(rows(spark, [2, 3], "later"), ["id"], "b") and ids(t) == [1, 2, 3]
    assert {r["v"] for r in t.read().collect()} == {"x1", "x2", "later3"}
    for i in range(4, 12):
        t.append_unseen(rows(spark, range(i)), ["id"], f"r{i}")
    assert ids(t) == list(range(12 - 1)) and t.folders("keys") <= 4 * 2 * 3
    assert t.read().columns == ["id", "v"]


def test_null_keys_are_values(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path), buckets=4)
    df = spark.createDataFrame([(None, 1), (1, None), (None, None), (None, 1)], "id long, w long")
    t.append_unseen(df, ["id", "w"], "a")
    t.append_unseen(df, ["id", "w"], "b")
    assert t.read().count() == 3


def test_a_run_reads_the_buckets_it_touches(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path), buckets=32)
    t.append_unseen(rows(spark, range(500)), ["id"], "a")
    asked = []
    read = t._read
    t._read = lambda m, kind, buckets=None: (asked.append(buckets), read(m, kind, buckets))[1]
    t.append_unseen(rows(spark, [7, 1000]), ["id"], "b")
    assert [len(a) for a in asked] in ([1], [2]) and len(ids(t)) == 501


def test_transform_sees_unseen_rows_only(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path), buckets=4)
    seen = []

    def double(df):
        seen.append(df.count())
        return df.where("id <> 3").withColumn("twice", F.col("id") * 2)

    t.append_unseen(rows(spark, [1, 2, 3]), ["id"], "a", transform=double)
    t.append_unseen(rows(spark, [1, 2, 3, 4]), ["id"], "b", transform=double)
    assert seen == [3, 2]      # what the transform dropped is looked at again
    assert {r["id"]: r["twice"] for r in t.read().collect()} == {1: 2, 2: 4, 4: 8}


def test_merge_rewrites_the_changed_buckets(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path), buckets=16)
    t.merge(rows(spark, range(200)), ["id"], "s", 0)
    before = {p["bucket"]: p["folder"] for p in t._load()["parts"]}
    t.merge(rows(spark, [1000], "new"), ["id"], "s", 1)
    after = {p["bucket"]: p["folder"] for p in t._load()["parts"]}
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    t.merge(rows(spark, [5, 6], "changed"), ["id"], "s", 2)
    t.merge(rows(spark, [5, 6], "again"), ["id"], "s", 2)
    got = {r["id"]: r["v"] for r in t.read().collect()}
    assert got == {i: f"x{i}" for i in range(200)} | {1000: "new1000", 5: "changed5", 6: "changed6"}
    t.merge(rows(spark, []), ["id"], "s", 3)
    assert t.read().count() == 201


def files(spark, path, parts):
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(str(path))


def test_stream_equals_batch_and_a_repeated_batch_adds_nothing(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    files(spark, src, [rows(spark, range(i * 10, i * 10 + 10)) for i in range(5)])
    run_append_commits(parquet_table_stream(spark, src, 1), out, ckpt, fan=3)
    t = ManifestTable(spark, out)
    assert ids(t) == list(range(50)) and t.folders() <= 3
    # the last batch's commit is in the table, but the stream lost its record of it
    last = max(int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit())
    for n in (f"{ckpt}/commits/{last}", f"{ckpt}/commits/.{last}.crc"):
        if os.path.exists(n):
            os.remove(n)
    files(spark, src, [rows(spark, [99])])
    run_append_commits(parquet_table_stream(spark, src, 1), out, ckpt, fan=3)
    assert ids(t) == [*range(50), 99]


def test_update_stream_equals_the_batch_aggregate(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    data = [spark.createDataFrame([(i % k if i % 5 else None,) for i in range(60)], "time_stamp long") for k in (3, 7, 40)]
    files(spark, src, data)
    run_update_commits(bucket_rate(parquet_table_stream(spark, src, 1)), ["time_stamp"], out, ckpt, buckets=8)
    want = bucket_rate(spark.read.parquet(src)).collect()
    assert sorted(map(str, ManifestTable(spark, out).read().collect())) == sorted(map(str, want))
