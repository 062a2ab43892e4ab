import random

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import minhash_dedup
from kestrel.llm.queries import QUERIES
from tests.llm.data import documents, odd_texts, prose


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_force(rows, width, percent=80):
    """(n_shingles, component) per row of (id, text)."""
    sets = [shingles(t, width) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    pairs = {(a, b) for ks in holders.values() for a in ks for b in ks if a < b}
    for a, b in pairs:
        i, j = rows[a][0], rows[b][0]
        both = len(sets[a] & sets[b])
        if i is not None and j is not None and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), find(i) if i is not None else None) for (i, _), s in zip(rows, sets))


def result(df):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("width", [2, 5])
def test_odd_documents(spark, width):
    texts = odd_texts()
    docs = documents(spark, texts)
    assert result(minhash_dedup.near_duplicates(docs, width)) == brute_force(list(enumerate(texts)), width)


def edited(words, n, rng):
    w = list(words)
    for p in rng.sample(range(len(w)), n):
        w[p] = f"e{rng.randrange(10**9)}"
    return " ".join(w)


def test_family_that_only_meets_at_its_base(spark):
    """Variants are similar to the base, not to each other; then without it."""
    rng = random.Random(1)
    base = prose(1, 200).split()
    variants = [edited(base, 10, rng) for _ in range(60)]
    for texts in ([*variants[:30], " ".join(base), *variants[30:]], variants):
        got = result(minhash_dedup.near_duplicates(documents(spark, texts), 2, block_rows=16))
        assert got == brute_force(list(enumerate(texts)), 2)


def test_only_members_of_shared_buckets_are_dealt_by_hubs(spark, monkeypatch):
    """Bands of documents that are like no other meet no hub."""
    rng = random.Random(3)
    base = prose(4, 200).split()
    texts = [f"{k} " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(30)) for k in range(300)]
    texts += [edited(base, 2, rng) for _ in range(40)]
    seen, join = [], minhash_dedup.hub_join

    def counted(rows, *args):
        seen.append(rows.count())
        return join(rows, *args)

    monkeypatch.setattr(minhash_dedup, "hub_join", counted)
    got = minhash_dedup.near_duplicates(documents(spark, texts), 2)
    assert result(got) == brute_force(list(enumerate(texts)), 2)
    assert seen and max(seen) <= 40 * 32


def test_buckets_of_two_are_not_compared_again(spark, monkeypatch):
    """Their one pair is a centre and its member; larger ones stay whole."""
    rng = random.Random(5)
    texts = []
    for k in range(60):
        base = prose(2000 + k, 100).split()
        texts += [" ".join(base)] + [edited(base, 8, rng) for _ in range(1 if k < 50 else 6)]
    seen, found = [], minhash_dedup._open_buckets

    def counted(members, roots):
        out = found(members, roots)
        seen.extend((r.m, r["count"]) for r in out.groupBy("band", "m").count().collect())
        return out

    monkeypatch.setattr(minhash_dedup, "_open_buckets", counted)
    assert result(minhash_dedup.near_duplicates(documents(spark, texts), 2)) == brute_force(list(enumerate(texts)), 2)
    assert seen and all(m == count > 2 for m, count in seen)


def test_no_pairs_read_no_texts(spark):
    """``docs`` without the columns that a join would need."""
    pairs = spark.createDataFrame([], "a long, ta long, b long, tb long")
    got = minhash_dedup.confirm(pairs, spark.range(3), 2, 80)
    assert got.columns == ["a", "b"] and got.isEmpty()


def test_random_near_copies_of_all_sizes(spark):
    rng = random.Random(2)
    texts = []
    for k in range(150):
        base = prose(1000 + k, rng.choice([3, 6, 12, 30, 100, 400])).split()
        texts += [" ".join(base)] + [edited(base, rng.randrange(max(1, len(base) // 8)), rng) for _ in range(rng.randrange(4))]
    got = minhash_dedup.near_duplicates(documents(spark, texts), 2)
    assert result(got) == brute_force(list(enumerate(texts)), 2)


def test_ids_and_one_of_each(spark):
    a, b, c = prose(1, 50), prose(2, 50), prose(3, 50)
    rows = [(7, a), (7, a), (3, a), (None, a), (None, b), (9, b), (8, b + " more"), (8, c), (2, c), (4, None), (4, None), (5, "")]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = minhash_dedup.near_duplicates(docs)
    assert result(got) == brute_force(rows, 5)
    kept = minhash_dedup.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    # 9, 8 and 2 hang together over the two texts of id 8
    want = [("3", a), ("2", c), ("4", None), ("5", ""), ("None", a), ("None", b)]
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted((i, str(t)) for i, t in want)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert minhash_dedup.near_duplicates(docs).collect() == [] and minhash_dedup.drop_near_duplicates(docs).collect() == []
    blank = documents(spark, [None, " "])
    assert result(minhash_dedup.near_duplicates(blank)) == [("0", 0, 0), ("1", 0, 1)]


def test_query_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(QUERIES["op6_minhash_near_dedup"](spark, sf)) == brute_force(rows, 2)


def test_one_permutation_estimates_similarity():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(0, 2**64, 40, dtype=np.uint64))
    b = np.sort(np.concatenate([a[:36], rng.integers(0, 2**64, 4, dtype=np.uint64)]))
    sig = minhash_dedup.one_permutation(np.concatenate([a, b, a[:1]]), np.repeat([0, 1, 3], [40, 40, 1]), 5, 1024)
    assert abs((sig[0] == sig[1]).mean() - 36 / 44) < 0.15
    assert (sig[3] == a[0]).all() and not sig[2].any() and not sig[4].any()


def test_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 500, rng.integers(0, 200)).astype(np.uint32)) for _ in range(30)]
    got = minhash_dedup.overlaps(sets, columns=64)
    for i in range(30):
        for j in range(30):
            assert i == j or got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_collisions_of_short_hashes_lose_no_link():
    """8 of 10 shingles are shared, two of them agree in 32 bits: 7 of 9."""
    shared = np.arange(7, dtype=np.uint32)
    sets = [np.append(shared, np.uint32(100)), np.append(shared, np.uint32(200)), np.arange(300, 309, dtype=np.uint32)]
    table = pa.table({"id": [1, 2, 3], "t": [4, 5, 6], "root": [1, 2, 3], "n": [9, 9, 9], "own": [0, 0, 0], "x": [0, 0, 0],
                      "y": [0, 0, 0], "hashes": pa.array([s.tobytes() for s in sets], pa.binary())})
    assert minhash_dedup._similar(80)(table).to_pylist() == [{"a": 1, "ta": 4, "b": 2, "tb": 5}]
