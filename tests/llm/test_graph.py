import random

import pytest

from pyspark.sql import functions as F

from kestrel.llm import graph
from kestrel.llm.graph import _with_low, components, hub_join, shared_id_links


def brute_force(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


GRAPHS = {
    "none": [], "loops and nulls": [(1, 1), (None, 2), (3, None)], "star": [(5, k) for k in range(6, 60)],
    "star of the largest": [(99, k) for k in range(40)], "path": [(k, k + 1) for k in range(70)],
    "path in random order": (lambda r: list(zip(r, r[1:])))(random.Random(1).sample(range(1000), 60)),
    "random": [(random.Random(k).randrange(200), random.Random(k + 999).randrange(200)) for k in range(110)],
    "repeats": [(1, 2), (2, 1), (1, 2), (2, 3), (-7, 3)],
}


@pytest.mark.parametrize("name", ["none", "loops and nulls", "star of the largest", "random", "repeats"])
def test_components_beyond_the_broadcast_bound(spark, name, monkeypatch):
    monkeypatch.setattr(graph, "BROADCAST_NODES", 0)
    rows = components(spark.createDataFrame(GRAPHS[name], "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == brute_force(GRAPHS[name]) and len(rows) == len({r.node for r in rows})


def test_a_round_of_few_links_is_one_written_table(spark, monkeypatch):
    seen, write = [], graph.written

    def counted(df, name):
        seen.append(name)
        return write(df, name)

    monkeypatch.setattr(graph, "written", counted)
    links = GRAPHS["star of the largest"] * 3
    assert {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == brute_force(links)
    assert len(seen) <= 2


@pytest.mark.parametrize("name", list(GRAPHS))
def test_components(spark, name):
    rows = components(spark.createDataFrame(GRAPHS[name], "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == brute_force(GRAPHS[name]) and len(rows) == len({r.node for r in rows})


def test_a_hub_is_not_shuffled(spark):
    """The rows of a hub stay in the partitions where they lie."""
    rows = [(0, k) for k in range(1, 3001)] + [(5000 + 2 * k, 5001 + 2 * k) for k in range(2000)]
    links = spark.createDataFrame(rows, "a long, b long")
    low = links.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("degree"))
    out = _with_low(links, low)
    got = {(r.a, r.b): r.low for r in out.collect()}
    assert len(got) == len(rows) and got == {(a, b): 1 if a == 0 else b for a, b in rows}
    lie = [sorted(r["count"] for r in df.where("a = 0").groupBy(F.spark_partition_id()).count().collect())
           for df in (links, out)]
    assert lie[0] == lie[1] and len(lie[0]) > 1
    assert {r.node: r.root for r in components(links).collect()} == brute_force(rows)


def test_shared_ids(spark):
    members = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 12), (3, 13), (3, 13)], "id long, node long")
    assert sorted((r.a, r.b) for r in shared_id_links(members).collect()) == [(11, 10), (12, 10)]


def test_hub_join_is_a_join_and_leaves_hubs_in_place(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4_001).alias("k"), "id").union(
        spark.range(5).select(F.lit(None).cast("long"), "id"))
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("high")).where("k <> 11")
    got = hub_join(rows, table, "k", "n")
    want = rows.join(table, "k")
    assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2
    assert hub_join(rows, table.where("n < 0"), "k", "n").isEmpty()
