import numpy as np
import pytest

from kestrel.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, node string, rows string, cell int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def brute_force(rows, least=0.98):
    ok = {}
    for i, v, label in rows:
        if v is None or label is None or i is None or any(e is None for e in v):
            continue
        x = np.array(v, np.float32).astype(float)
        if len(x) and np.isfinite(x).all() and x.any():
            ok[i] = (label, x / np.linalg.norm(x))
    links = {i: [j for j, (m, y) in ok.items() if j != i and m == ok[i][0] and len(y) == len(ok[i][1]) and y @ ok[i][1] >= least]
             for i in ok}
    out = {}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links.get(i, [])), min(seen) if i is not None else None)
    return out


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def clustered(n, dim, spread, seed, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(max(2, n // 12), dim))
    x = centre[rng.integers(0, len(centre), n)] + spread * rng.normal(size=(n, dim))
    return [(i, [float(e) for e in x[i]], i % labels) for i in rng.permutation(n).tolist()]


@pytest.mark.parametrize("dim,spread", [(4, 0.15), (16, 0.12), (16, 0.2)])
def test_matches_all_pairs(spark, dim, spread):
    """Small cells and blocks, so that links cross cells and blocks."""
    rows = clustered(500, dim, spread, dim)
    got = result(embed_dedup.near_duplicate_vectors(table(spark, rows), cell_rows=8, block_rows=16))
    want = brute_force(rows)
    assert sum(n for n, _ in want.values()) > 200
    assert got == want


def test_hot_group_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=8)
    rows = [(i, [float(e) for e in base], 0) for i in range(150)]
    rows += [(150 + i, [float(e) for e in base + 0.1 * rng.normal(size=8)], 0) for i in range(150)]
    rows += [(300 + i, [float(e) for e in rng.normal(size=8)], 0) for i in range(100)]
    got = result(embed_dedup.near_duplicate_vectors(table(spark, rows), cell_rows=50, block_rows=32))
    assert got == brute_force(rows)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [1.0, nan], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0, -0.0], 1)]
    assert result(embed_dedup.near_duplicate_vectors(table(spark, rows))) == brute_force(rows)
    out = embed_dedup.near_duplicate_vectors(table(spark, [(None, [1.0], 1), (1, [1.0], 1), (2, [1.0], 1), (2, [1.0], 1)])).collect()
    assert sorted((str(r.vec_id), r.component_id, r.kept) for r in out) == [
        ("1", 1, True), ("2", 1, False), ("2", 1, False), ("None", None, True)]


def test_no_square_overflows(spark):
    rows = [(1, [1e200, 2e200], 1), (2, [1.01e200, 2e200], 1), (3, [1e-200, 2e-200], 1), (4, [2e-200, -1e-200], 1),
            (5, [1e308, -1e308], 1), (6, [5e-324, 0.0], 1), (7, [3.0, 0.0], 1), (8, [1e-310, 1e-318], 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(embed_dedup.near_duplicate_vectors(docs)) == {
        1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5), 6: (2, 6), 7: (2, 6), 8: (2, 6)}


def test_empty_table(spark):
    assert embed_dedup.near_duplicate_vectors(table(spark, [])).collect() == []
    assert len(embed_dedup.near_duplicate_vectors(table(spark, [(1, None, None)])).collect()) == 1
