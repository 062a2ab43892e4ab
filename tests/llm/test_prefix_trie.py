import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from kestrel.llm import prefix_trie as pt
from kestrel.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, seq int, lens string, depth int, head string, key string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y", "z") for r in rows], SCHEMA)


def brute_force(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role, mark, text))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seqs[c] = tuple(own.get(head, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(cs), len(p), str(min(members[p[:-1]]) if p else None), len(cs), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(cs) if seqs[c] == p).encode()).hexdigest())
                  for p, cs in members.items())


def trie(spark, rows, **kw):
    out = pt.prefix_trie(pt.rebuilt(table(spark, rows), turns=pt.shared_opening()), **kw)
    assert sorted(out.columns) == sorted(NAMES)
    return sorted((r.conv_id, r.depth, str(r.parent_conv_id), r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in out.collect())


def random_rows(seed, n, turns, words, spread=400):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-spread // 4, spread), n):
        for t in range(rng.randrange(1, turns)):
            rows.append((c, t if rng.random() < .9 else None, rng.choice(["user", "bot", None]),
                         rng.choice([None, "", *["word " * (1 + i) for i in range(words)]])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,turns,words", [(1, 200, 12, 1), (2, 300, 5, 4), (3, 60, 60, 1)])
def test_matches_brute_force(spark, seed, n, turns, words):
    rows = random_rows(seed, n, turns, words)
    assert trie(spark, rows) == brute_force(rows)


def test_boundaries_between_blocks_and_ranges(spark, monkeypatch):
    """Blocks of a few sequences, many ranges, two forests at a time."""
    monkeypatch.setattr(pt, "FAN_IN", 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed, n, turns, words in ((4, 150, 9, 1), (5, 150, 4, 3)):
            rows = random_rows(seed, n, turns, words)
            assert trie(spark, rows, block_rows=3) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_local_merges_match_one_block():
    """Forests of any split of the sorted sequences give the same nodes."""
    rng = random.Random(8)
    for trial in range(60):
        turn = [bytes([i]) * pt.WIDTH for i in range(3)]
        seqs = sorted({b"".join(rng.choices(turn, k=rng.randrange(0, 7))) for _ in range(rng.randrange(1, 60))})
        convs = rng.sample(range(1000), len(seqs))
        rows = [(s, [3 + x for x in s[::pt.WIDTH]], c, rng.randrange(1, 4), f"e{c}") for s, c in zip(seqs, convs)]

        def nodes(size, fan_in):
            out, spines = pt.Output(0), []
            for lo in range(0, len(rows), size):
                spines.append(pt.block_forest(*[list(c) for c in zip(*rows[lo:lo + size])], out))
            while len(spines) > 1:
                spines = [pt.merge_spines(spines[i:i + fan_in], out, False) for i in range(0, len(spines), fan_in)]
            pt.merge_spines(spines, out, True)
            found = {r[5]: r[1] for r in out.rows if r[5]}
            return sorted((r[1], r[2], str(found[r[4]] if r[4] else r[3]), *r[6:10], str(r[10])) for r in out.rows)

        whole = nodes(len(rows), 2)
        assert nodes(rng.randrange(1, 5), rng.randrange(2, 5)) == whole
        assert len(whole) == len({s[:i] for s in seqs for i in range(0, len(s) + 1, pt.WIDTH)} | {b""})


def test_hot_opening_hot_conversation_and_a_long_one(spark):
    rows = [(c, t, "user", f"hello {t}") for c in range(1000) for t in range(3)]
    rows += [(1000 + c, t, "user", "hello 0" if t == 0 else f"other {c}") for c in range(300) for t in range(2)]
    rows += [(5000, t, "bot", f"turn {t % 7}") for t in range(3000)] + [(5007, t, "bot", f"turn {t % 7}") for t in range(2999)]
    rows += [(9000, 0, "user", "long " * 200_000)]
    assert trie(spark, rows) == brute_force(rows)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(None, 0, "user", "lost"), (100, 0, None, "x"), (101, 7, "user", None), (101, 7, "user", None), (101, None, "b", "y"),
            (102, 3, "b", "tie"), (102, 3, "a", "tie"), (102, 3, "a", "tie too"), (317, 0, "user", "no head"), (318, 0, "", ""),
            (-5, 0, "user", "x"), (-105, 1, "user", "x"), (-105, 0, None, "é😀")]
    assert trie(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_ends_are_hashed_in_runs(spark, monkeypatch):
    monkeypatch.setattr(pt, "PACK_BYTES", 20)
    ids = random.Random(4).sample(range(100_000), 3000)
    got = {r.key: r.ends for r in pt.end_digests(spark.createDataFrame([(str(i % 3 > 0), i) for i in ids], "key string, conv_id long")).collect()}
    assert got == {k: hashlib.sha256(",".join(str(i) for i in sorted(ids) if str(i % 3 > 0) == k).encode()).hexdigest()
                   for k in ("True", "False")}


def test_without_shared_openings(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a")]
    got = pt.prefix_trie(pt.rebuilt(table(spark, rows))).collect()
    assert sorted((r.conv_id, r.depth, r.n_convs, r.saved_tokens) for r in got) == [(1, 0, 2, 1), (1, 1, 2, 1), (1, 2, 1, 0)]


def test_query_is_registered_with_its_twin():
    assert "op12_conversation_trie" in QUERIES and "op12_conversation_trie" in ORACLE_SQL
