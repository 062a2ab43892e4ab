import hashlib

import numpy as np
import pytest

from kestrel.llm import suffix_dedup, suffixes
from kestrel.llm.queries import QUERIES
from kestrel.llm.text import CHUNK_BYTES
from tests.llm.data import documents, odd_texts, prose


def brute_force(rows, window=50):
    """Expected (n_bytes, n_removed, n_spans, kept) per (id, text)."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    key = lambda i: float("inf") if i is None else i
    for i, b in sorted(texts, key=lambda r: key(r[0])):
        for p in range(len(b) - window + 1):
            first.setdefault(b[p:p + window], key(i))
    out = []
    for i, b in texts:
        step = np.zeros(len(b) + 1, int)
        for p in range(len(b) - window + 1):
            if first[b[p:p + window]] < key(i):
                step[p] += 1
                step[p + window] -= 1
        gone = np.cumsum(step[:-1]) > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def result(df):
    return [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()]


def order(rows):
    return sorted(rows, key=str)


def test_odd_documents(spark):
    texts = odd_texts()
    docs = documents(spark, texts)
    assert order(result(suffix_dedup.remove_repeats(docs))) == order(brute_force(list(enumerate(texts))))


def test_repeated_and_missing_ids(spark):
    a, b = prose(7, 60), prose(8, 60)
    rows = [(5, a), (5, a), (5, a + b), (None, b), (None, b), (9, b), (3, b[:49]), (4, b[:50])]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    assert order(result(suffix_dedup.remove_repeats(docs))) == order(brute_force(rows))


def test_longer_than_a_chunk(spark):
    long = prose(11, 420_000, 100_000)
    assert len(long) > CHUNK_BYTES + 50
    edge = CHUNK_BYTES
    rows = [(0, long[edge - 400:edge + 400]), (1, long), (2, "x" * 10 + long[:CHUNK_BYTES + 1000])]
    docs = documents(spark, [t for _, t in rows])
    assert order(result(suffix_dedup.remove_repeats(docs))) == order(brute_force(rows))


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).collect() == []


HOT_LINE = "== all rights reserved 2024 =="


def test_a_hot_line_has_no_bucket_of_its_own(spark):
    assert len(HOT_LINE) == 30
    texts = [f"{prose(k, 12)} {HOT_LINE if k % 3 == 0 else ''} {prose(k + 5000, 12)}" for k in range(900)]
    docs = documents(spark, texts)
    base = docs.selectExpr("doc_id", "xxhash64(doc_id, text) rid", "cast(text as binary) text")
    rows = suffix_dedup.offered(base, hot_windows=256).collect()
    assert any(r.hot for r in rows)
    line, of_line = HOT_LINE.encode(), {}
    for r in (r for r in rows if r["size"] is not None):
        meta = suffix_dedup._unpack(r.meta, r.n, *(suffix_dedup._SPAN if r.hot else suffix_dedup._META))
        body = suffix_dedup._unpack(r.body, r["size"], "u1")[0].tobytes()
        length = [50] * r.n if r.hot else meta[0].tolist()
        ends = np.cumsum(length).tolist()
        of_line[r.bucket] = of_line.get(r.bucket, 0) + sum(line in body[e - k:e] for e, k in zip(ends, length))
    # every bucket has a share; before, all windows of an anchor went to one
    total = sum(of_line.values())
    assert total > 900 and max(of_line.values()) < total / 4
    assert order(result(suffix_dedup.remove_repeats(docs, hot_windows=256))) == order(brute_force(list(enumerate(texts))))


@pytest.mark.parametrize("hot_windows", [0, 40])
def test_hot_anchors_of_odd_documents(spark, hot_windows):
    blank, ha = " " * 3000, "ha " * 700
    rows = [*enumerate(odd_texts()), (50, blank), (51, blank[:200] + "x" + blank), (51, ha), (52, "b" + ha), (None, ha),
            (None, blank), (7, blank[:60] + ha), *[(60 + k, prose(k, 9) + HOT_LINE * 3 + prose(k // 3, 9)) for k in range(40)]]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    assert order(result(suffix_dedup.remove_repeats(docs, hot_windows=hot_windows))) == order(brute_force(rows))


def test_no_bucket_gets_what_every_task_begins_with(spark):
    """All entries of both shuffles, settled ones too, over many partitions."""
    common = prose(77, 30)
    texts = [f"{prose(k, 20)} {common} {prose(k // 2 + 9000, 30)}" for k in range(1200)]
    base = documents(spark, texts).selectExpr("doc_id", "xxhash64(doc_id, text) rid", "cast(text as binary) text").repartition(48, "rid")
    base = spark.createDataFrame(base.collect(), base.schema).repartition(48, "rid")
    width = 32

    def spread(rows, kind):
        n = {}
        for r in rows:
            if kind(r):
                n[r.bucket] = n.get(r.bucket, 0) + r.n
        return [n.get(b, 0) for b in range(width)]

    known = spread(suffix_dedup.announced(base, 50, width).collect(), lambda r: r.known)
    assert sum(known) > 1000 and max(known) <= 4 * sum(known) / width
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = suffix_dedup.offered(base).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    everything = spread(rows, lambda r: True)
    assert max(everything) <= 4 * sum(everything) / width
    settled = [r.bucket for r in rows if r["size"] is None]
    assert len(settled) >= 20 and max(settled.count(b) for b in settled) <= 6


def test_the_hottest_anchors_are_listed(spark):
    texts = [f"{prose(k, 12)} {HOT_LINE if k % 3 == 0 else ''} {prose(k + 5000, 12)}" for k in range(300)]
    base = documents(spark, texts).selectExpr("doc_id", "xxhash64(doc_id, text) rid", "cast(text as binary) text")
    _, all_hot = suffix_dedup.shared_anchors(base, 50, 8, 40)
    _, two = suffix_dedup.shared_anchors(base, 50, 8, 40, hot_listed=2)
    assert len(all_hot) > 2 and len(two) == 2 and set(two) <= set(all_hot)


def test_query_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    got = [tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
           for r in QUERIES["op1_suffix_dedup"](spark, sf).collect()]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert order(got) == order(brute_force(rows))


@pytest.mark.parametrize("alphabet", [1, 2, 26])
def test_sort_suffixes(alphabet):
    rng = np.random.default_rng(alphabet)
    buf = rng.integers(97, 97 + alphabet, 400).astype(np.uint8)
    start = rng.permutation(300)
    group = np.sort(rng.integers(0, 4, 300))
    hashes = suffixes.PrefixHashes(buf)
    got = suffixes.sort_suffixes(hashes, start, group, 50)
    text = lambda i: bytes(buf[start[i]:start[i] + 50])
    want = sorted(range(300), key=lambda i: (group[i], text(i)))
    assert [(group[i], text(i)) for i in got] == [(group[i], text(i)) for i in want]
    run = suffixes.equal_groups(hashes, start, group, got, 50)
    same = [(group[a], text(a)) == (group[b], text(b)) for a, b in zip(got, got[1:])]
    assert [x == y for x, y in zip(run, run[1:])] == same


def test_common_extension():
    buf = np.frombuffer(b"abcabcabdabcabcabd", np.uint8)
    h = suffixes.PrefixHashes(buf)
    assert h.common(np.array([0, 0, 0]), np.array([3, 9, 1]), 9).tolist() == [5, 9, 0]
