"""Stream fixtures: rate per bucket over two micro-batches, scoring a stream."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.parse import parse_delimited
from kestrel.operators.ml import train_model
from kestrel.schemas import CONNECTION_SCHEMA, STREAM_FIELDS
from kestrel.session import scratch_path
from kestrel.streaming.rate import bucket_rate, window_rate
from kestrel.streaming.scoring import parse_stream_lines, score_stream
from kestrel.streaming.sinks import read_current, run_append_by_batch, run_complete_overwrite, versions
from kestrel.streaming.sources import text_lines_stream


def _msg(bucket, service="http", duration="0", newline=True):
    feats = [duration, "tcp", service, "SF"] + ["0"] * 37
    line = ",".join(feats) + ("\n" if newline else "")
    return line + ("" if bucket is None else f",{bucket}")


def test_parse_stream_message(spark):
    lines = [_msg(1), _msg(None), _msg(2, duration="x"), ""]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = parse_delimited(df, "value", STREAM_FIELDS).collect()
    assert out[0]["time_stamp"] == 1 and out[0]["dst_host_srv_rerror_rate"] == 0.0  # "0\n" parses
    assert out[1]["time_stamp"] is None
    assert out[2]["duration"] is None and out[2]["time_stamp"] == 2
    assert out[3]["duration"] is None and out[3]["protocol_type"] is None


def test_bucket_rate_two_batches(spark):
    d = tempfile.mkdtemp(prefix="kestrel-stream-")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("".join(m + "\n" for m in [_msg(1), _msg(1), _msg(2), _msg(None)]))
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("".join(m + "\n" for m in [_msg(2), _msg(3)]))
    # each message spans two physical lines (the newline before ",bucket"), so a
    # text file stream would split them; use one message per line instead
    for name in ("a.txt", "b.txt"):
        p = os.path.join(d, name)
        txt = open(p).read().replace("\n,", ",")
        open(p, "w").write(txt)
    lines = text_lines_stream(spark, d, max_files_per_trigger=1)
    agg = bucket_rate(parse_stream_lines(lines, STREAM_FIELDS))
    out = scratch_path(spark, "t-rate")
    q = run_complete_overwrite(agg, out, scratch_path(spark, "t-rate-ckpt"))
    assert q.lastProgress is not None
    got = {r["time_stamp"]: r["rate"] for r in read_current(spark, out).collect()}
    assert got == {1: 2, 2: 2, 3: 1, None: 0}


def test_window_rate_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="kestrel-win-")
    rows = [(i, f"2024-01-01 00:00:{(i * 7) % 60:02d}") for i in range(50)]
    src = spark.createDataFrame(rows, "id long, t string").select(
        "id", F.to_timestamp_ntz("t").alias("ts"))
    src.write.parquet(os.path.join(base, "ev"))
    batch = {r["window_start"]: r["rate"] for r in window_rate(src, "ts", "10 seconds").collect()}
    stream = spark.readStream.schema(src.schema).parquet(os.path.join(base, "ev"))
    out = scratch_path(spark, "t-win")
    run_complete_overwrite(window_rate(stream, "ts", "10 seconds", watermark="1 minute"), out,
                           scratch_path(spark, "t-win-ckpt"))
    got = {r["window_start"]: r["rate"] for r in read_current(spark, out).collect()}
    assert got == batch and sum(got.values()) == 50


def _train_frame(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        attack = rng.random() < 0.4
        vals = [float(rng.random() * (10 if attack else 1)), "tcp", rng.choice(["http", "ftp"]), "SF"]
        vals += [float(rng.random() * (100 if attack else 1)) for _ in range(11)]
        vals += [int(rng.random() * 3) for _ in range(5)]
        vals += [0.0, 0.0, int(rng.random() * 50), int(rng.random() * 50)]
        vals += [float(rng.random()) for _ in range(17)]
        vals += ["smurf" if attack else "normal"]
        rows.append(tuple(vals))
    df = spark.createDataFrame(rows, CONNECTION_SCHEMA)
    return df.withColumn("category", F.when(F.col("attack") == "smurf", "dos_attacks").otherwise("normal"))


def test_score_stream_unseen_service(spark):
    train = _train_frame(spark)
    model = train_model(train, label_col="category")
    d = tempfile.mkdtemp(prefix="kestrel-score-")
    with open(os.path.join(d, "m.txt"), "w") as f:
        f.write(_msg(1, service="never_seen_service").replace("\n,", ",") + "\n")
        f.write(_msg(1).replace("\n,", ",") + "\n")
    rows = parse_stream_lines(text_lines_stream(spark, d))
    scored = score_stream(model, rows)
    out = scratch_path(spark, "t-score")
    run_append_by_batch(scored, out, scratch_path(spark, "t-score-ckpt"))
    got = spark.read.parquet(out).collect()
    assert len(got) == 2 and {r["category"] for r in got} <= {"normal", "dos_attacks"}
    assert "features" not in spark.read.parquet(out).columns


def test_append_sink_restart_is_exactly_once(spark):
    d = tempfile.mkdtemp(prefix="kestrel-replay-")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("x,1\ny,2\n")
    out, ckpt = scratch_path(spark, "t-replay"), scratch_path(spark, "t-replay-ckpt")

    def run():
        rows = parse_delimited(text_lines_stream(spark, d), "value",
                               [("name", T.StringType()),
                                ("v", T.IntegerType())])
        run_append_by_batch(rows, out, ckpt)
        return spark.read.parquet(out)

    first = run()
    assert first.count() == 2
    again = run()                       # restart on the same checkpoint: nothing new
    assert again.count() == 2
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("z,3\n")
    third = run()
    assert third.count() == 3 and third.select("batch_id").distinct().count() == 2


def test_rate_state_in_rocksdb_restarts(spark):
    """The stateful rate keeps its state in RocksDB and carries it over a
    restart on the same checkpoint (a bucket touched by two runs)."""
    from kestrel.streaming.sinks import ROCKSDB_PROVIDER
    d = tempfile.mkdtemp(prefix="kestrel-rocks-")
    out, ckpt = scratch_path(spark, "t-rocks"), scratch_path(spark, "t-rocks-ckpt")

    def run():
        lines = text_lines_stream(spark, d)
        agg = bucket_rate(parse_delimited(lines, "value", [("x", T.StringType()),
                                                           ("time_stamp", T.IntegerType())]))
        run_complete_overwrite(agg, out, ckpt, state_store="rocksdb")
        return {r["time_stamp"]: r["rate"] for r in read_current(spark, out).collect()}

    keys = ("spark.sql.streaming.stateStore.providerClass",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        with open(os.path.join(d, "a.txt"), "w") as f:
            f.write("a,1\nb,1\nc,2\n")
        assert run() == {1: 2, 2: 1}
        assert spark.conf.get(keys[0]) == ROCKSDB_PROVIDER
        with open(os.path.join(d, "b.txt"), "w") as f:
            f.write("d,2\ne,3\n")
        assert run() == {1: 2, 2: 2, 3: 1}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_window_rate_does_not_depend_on_the_session_zone(spark, zone):
    """Half-hour offsets and the hours around a clock change."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 03:30:00", "2024-11-03 01:10:00",
                 "2024-11-03 01:50:00", "1969-12-31 23:59:59.999999"]
        df = spark.createDataFrame([(t,) for t in times], "t string").select(F.to_timestamp_ntz("t").alias("ts"))
        want = {"2024-03-10 01:00:00": 1, "2024-03-10 02:00:00": 1, "2024-03-10 03:00:00": 1,
                "2024-11-03 01:00:00": 2, "1969-12-31 23:00:00": 1}
        for watermark in (None, "1 hour"):
            got = {str(r["window_start"]): r["rate"] for r in window_rate(df, "ts", "1 hour", watermark).collect()}
            assert got == want
            assert window_rate(df, "ts", "1 hour", watermark).schema["window_start"].dataType == T.TimestampNTZType()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_replaced_results_switch_versions(spark):
    d = tempfile.mkdtemp(prefix="kestrel-versions-")
    out, ckpt = scratch_path(spark, "t-versions"), scratch_path(spark, "t-versions-ckpt")
    with pytest.raises(FileNotFoundError):
        read_current(spark, out)
    for k in range(4):
        with open(os.path.join(d, f"{k}.txt"), "w") as f:
            f.write("x\n" * (k + 1))
        run_complete_overwrite(text_lines_stream(spark, d).groupBy("value").count(), out, ckpt)
        assert read_current(spark, out).first()["count"] == sum(range(1, k + 2))
    assert versions(spark, out) == [2, 3]


def test_append_sink_takes_a_table_writer(spark):
    d = tempfile.mkdtemp(prefix="kestrel-writer-")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("x\ny\n")
    seen = []
    run_append_by_batch(text_lines_stream(spark, d), "a table", scratch_path(spark, "t-writer-ckpt"),
                        writer=lambda df, path, batch: seen.append((path, batch, sorted(r[0] for r in df.collect()))))
    assert seen == [("a table", 0, ["x", "y"])]


def test_clear_scratch_removes_what_was_made(spark):
    from kestrel.session import clear_scratch
    spark.range(3).write.parquet(path := scratch_path(spark, "t-clear"))
    assert os.path.isdir(path.removeprefix("file:"))
    assert clear_scratch(spark) >= 1 and not os.path.isdir(path.removeprefix("file:"))


def test_timeout_leaves_the_query_running(spark):
    d = tempfile.mkdtemp(prefix="kestrel-timeout-")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("x\n")
    out = scratch_path(spark, "t-timeout")
    for run in (lambda: run_append_by_batch(text_lines_stream(spark, d), out, scratch_path(spark, "t-timeout-ckpt"),
                                            available_now=False, processing_time="100 milliseconds", timeout=4),
                lambda: run_complete_overwrite(text_lines_stream(spark, d).groupBy("value").count(), f"{out}-all",
                                               scratch_path(spark, "t-timeout-ckpt2"), available_now=False,
                                               processing_time="100 milliseconds", timeout=6)):
        q = run()
        try:
            assert q.isActive
        finally:
            q.stop()
    assert spark.read.parquet(out).count() == 1 and read_current(spark, f"{out}-all").first()["count"] == 1
