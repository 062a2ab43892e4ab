import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.llm import mixing, prefix
from tests.llm.data import documents, prose


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """By the stated procedure: deal by weight, cap, deal the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        dealt = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if dealt[s] >= most * sizes[s]]
        if not over:
            return capped | dealt
        capped |= {s: most * sizes[s] for s in over}


def check(df):
    rows = df.collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        taken = sum(r.taken for r in mine)
        assert want[s] - 2 <= taken <= want[s] + 1e-6
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
        # whole documents except one at the cut
        if len({r.doc_id for r in mine}) == len(mine):
            assert sum(r.size > 0 and r.taken % r.size != 0 for r in mine) <= 1
    return rows


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["a", "b", "é", "B", None, "", "zz"])), min_size=1, max_size=40))
def test_targets_are_met(spark, rows):
    docs = documents(spark, [prose(k, n) if n else None for k, (n, _) in enumerate(rows)], sources=[s for _, s in rows])
    first = check(mixing.mix(docs, rows_per_range=4))
    again = mixing.mix(docs.repartition(3), rows_per_range=4).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_hot_source_and_long_text(spark):
    texts = [prose(k, 5 + k % 30) for k in range(600)] + [prose(9999, 60_000)]
    docs = documents(spark, texts, sources=["hot" if k % 3 else f"s{k % 9}" for k in range(601)])
    rows = check(mixing.mix(docs, rows_per_range=16))
    assert len(rows) == 601 and [c for c in mixing.mix(docs).columns[:12]][0] == "doc_id"


def test_repeated_rows_share_the_cut(spark):
    docs = documents(spark, [prose(1, 10)] * 50 + [None, ""], ids=[1] * 40 + [None] * 10 + [2, 3], sources=["a"] * 52)
    rows = mixing.mix(docs).collect()
    taken = sum(r.taken for r in rows)
    assert 750 - 40 <= taken <= 750 and all(r.taken <= 20 for r in rows)


def test_the_mix_is_made(spark):
    gaps = ["  \t", "\n", " \u00a0 ", " "]
    texts = [gaps[k % 4] + gaps[k % 3].join(prose(k, 5 + k % 17).split()) + " " for k in range(200)] + [None, " "]
    docs = documents(spark, texts, sources=[["big", "small", None][min(k % 7, 2)] for k in range(202)])
    counted = {r.doc_id: r for r in mixing.mix(docs).collect()}
    made = mixing.make_mix(docs)
    assert made.columns[:len(docs.drop("size").columns)] == docs.drop("size").columns
    rows, words, per_source = {}, mixing.word_count(F.col("text")).alias("words"), {}
    for r in made.select("doc_id", "source", "text", "n_chars", "epoch", "taken", words).collect():
        rows.setdefault(r.doc_id, []).append(r)
        per_source[r.source] = per_source.get(r.source, 0) + r.words
        assert r.words == r.taken and r.n_chars == len(r.text) and texts[r.doc_id].startswith(r.text)
    assert rows.keys() == {i for i, r in counted.items() if r.taken}
    for i, mine in rows.items():
        mine.sort(key=lambda r: r.epoch)
        assert [r.epoch for r in mine] == list(range(1, len(mine) + 1))
        assert sum(r.words for r in mine) == counted[i].taken and all(r.text == texts[i] for r in mine[:-1])
    assert max(map(len, rows.values())) == 2 and any(m[-1].text != texts[i] for i, m in rows.items())
    for r in counted.values():
        assert r.target - 2 <= per_source[r.source] <= r.target + 1e-6
    assert mixing.make_mix(documents(spark, [None, " "])).collect() == []


def test_empty_table(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(documents(spark, [None, " "])).collect()] == [0, 0]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_running_sums(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 1009).alias("k"), F.lit(2).alias("v"))
    got = sorted((r.k, r.s) for r in prefix.running_sums(df, ["k"], {"s": "v"}).collect())
    assert got == [(k, 2 * (i + 1)) for i, k in enumerate(sorted(k * 7919 % 1009 for k in range(n)))]
