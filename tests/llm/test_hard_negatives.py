import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, shard string, cell string, score int, rank string, q int, dim int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z", 2, 3) for r in rows], SCHEMA)


def brute_force(rows, scale=256):
    ok = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x * scale) for x in v):
            continue
        if i not in ok or (label, v) < ok[i][:2]:
            ok[i] = (label, v, [math.floor(x * scale) for x in v])
    out = []

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    for a, (label, _, q) in ok.items():
        if a % 10:
            continue
        near = sorted((-score(q, r), i) for i, (m, _, r) in ok.items() if i != a and m == label and len(r) == len(q))[:5]
        far = sorted((-score(q, r), i) for i, (m, _, r) in ok.items() if m != label and len(r) == len(q))
        for p, pid in near:
            fits = [(s, i) for s, i in far if -80 * p <= -100 * s <= -100 * p][:5]
            out += [(a, pid, k + 1, i, -p, -s) for k, (s, i) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **kw):
    got = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, **kw).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


def clustered(n, dim, spread, seed, labels=3, offset=0.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(max(2, n // 25), dim)) + offset
    x = centre[rng.integers(0, len(centre), n)] + spread * rng.normal(size=(n, dim))
    return [(i, [float(e) for e in x[i]], int(i % labels)) for i in rng.permutation(n).tolist()]


@pytest.mark.parametrize("dim,spread,offset", [(8, 0.2, 0.0), (5, 0.05, 0.0), (16, 1.0, 1.0)])
def test_matches_brute_force_over_many_shards(spark, monkeypatch, dim, spread, offset):
    monkeypatch.setattr(hn, "CELL_ROWS", 8)
    monkeypatch.setattr(hn, "FIRST_ROWS", 4)
    rows = clustered(600, dim, spread, dim, offset=offset)
    want = brute_force(rows)
    assert len(want) > 100
    assert mined(spark, rows, shard_rows=32, anchor_block=16) == want
    assert mined(spark, rows) == want


def test_cells_come_by_falling_bound_and_bounds_hold():
    rng = np.random.default_rng(6)
    x = np.floor(40 * rng.normal(size=(900, 6)))
    space = hn.Space((hn.fit_codes(x[:, :3], 5), hn.fit_codes(x[:, 3:], 5)))
    cell, away = space.encode(x)
    known = np.unique(cell)
    far = np.array([away[cell == c].max(axis=0) for c in known])
    for a in x[:50]:
        seen = list(hn.visit_cells(space, a, known, far))
        bounds = [b for _, b in seen]
        assert sorted(c for c, _ in seen) == list(range(len(known)))
        assert bounds == sorted(bounds, reverse=True)
        assert all((x[cell == known[c]] @ a).max() <= b for c, b in seen)


def test_clear_clusters_are_certified_early():
    """A window is closed after few of the rows where clusters lie apart."""
    rng = np.random.default_rng(1)
    corner = 300 * np.array([[1, 1, 1, 1], [-1, -1, 1, 1], [1, 1, -1, -1], [-1, -1, -1, -1]])
    x = np.floor(np.repeat(corner, 500, axis=0) + 3 * rng.normal(size=(2000, 4)))
    space = hn.Space((hn.fit_codes(x[:, :2], 2), hn.fit_codes(x[:, 2:], 2)))
    cell, away = space.encode(x)
    order = np.argsort(cell, kind="stable")
    offered = []

    class Counting(hn._Window):
        def offer(self, score, ids):
            offered.append(len(score))
            super().offer(score, ids)

    window = Counting(hn._HIGH, hn._LOW, 5)
    hn.search_shard(space, x[order], order, np.zeros(2000), cell[order], away[order], x[0], 0, 0, [window], True)
    assert sum(offered) <= 1000
    scores = sorted(((-int(s), i) for i, s in enumerate(x @ x[0]) if i), key=lambda t: t)[:5]
    assert window.best == scores


def test_hot_label_copies_and_ties(spark):
    rng = np.random.default_rng(3)
    base = [float(e) for e in rng.normal(size=6)]
    rows = [(i, base, 0) for i in range(150)] + [(150 + i, base, 1) for i in range(150)]
    rows += [(300 + i, [float(e) for e in rng.normal(size=6)], i % 4) for i in range(100)]
    assert mined(spark, rows, shard_rows=40) == brute_force(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 1.0], 1), (10, [1.0, 1.0], 1), (11, [1.0, 0.9], 1), (12, [0.9, 0.9], 2), (13, None, 1), (14, [1.0, None], 1),
            (15, [nan, 1.0], 1), (16, [inf, 1.0], 2), (17, [1.0, 1.0], None), (18, [1.0], 2), (19, [0.9, 0.9, 0.0], 2), (20, [], 1),
            (21, [], 1), (22, [], 2), (30, [2.0], 2), (31, [3.0], 2), (32, [2.9], 1), (33, [1e308, 1.0], 2),
            (40, [-1.0, -1.0], 1), (12, [0.9, 0.9], 2), (11, [5.0, 5.0], 3), (-50, [1.0, 1.0], 2), (50, [0.0, 0.0], 3), (51, [0.0, 0.0], 3),
            (60, [1e-9, -1e-9], 4)]
    assert mined(spark, rows) == brute_force(rows)


def test_large_components_score_exactly(spark):
    big = 2.0**25
    rows = [(10, [2.0**20, 3.0], 1), (11, [big + 1, 1.0], 1), (12, [big, 257.0 / 256], 2), (13, [big, 1.0], 2), (14, [big + 1, 1.0], 2)]
    want = brute_force(rows)
    assert mined(spark, rows) == want
    assert [r[3] for r in want] == [14, 12, 13] and want[1][5] - want[2][5] == 3 * 256 and want[0][4] > 2**53


def test_scores_beyond_a_long_are_held_at_its_ends(spark):
    rows = [(10, [1e200, 1.0], 1), (11, [1e200, 0.0], 1), (12, [1e300, 0.0], 2), (13, [0.0, 1e300], 2), (14, [-1e300, 0.0], 2), (15, [0.0, 0.0], 2)]
    assert mined(spark, rows) == [(10, 11, 1, 12, 2**63 - 1, 2**63 - 1), (10, 11, 2, 13, 2**63 - 1, 2**63 - 1)]


def test_many_vector_lengths(spark, monkeypatch):
    monkeypatch.setattr(hn, "MAX_DIMS", 2)
    monkeypatch.setattr(hn, "CELL_ROWS", 4)
    rng = np.random.default_rng(9)
    rows = [(i, [float(e) for e in rng.normal(size=1 + i % 7)], i % 2) for i in range(400)]
    assert mined(spark, rows, shard_rows=16) == brute_force(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 1)]) == []
    assert mined(spark, [(10, None, 1)]) == []
