"""Connected components of a link table, by alternating star contractions.

Each round reduces to per-node minima (combined map-side) and a join with them;
no node's neighbours are gathered in one row or, for a hub, in one task.  Rounds
are logarithmic in the longest path, and each round's links are written to the
shared folder.  Where the nodes fit ``BROADCAST_NODES`` their minima are
broadcast, so that links don't move and a round is one query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.scratch import written


#: minima of so many nodes (16 bytes each) may be broadcast
BROADCAST_NODES = 200_000
#: a node that holds at least one in so many of all link ends is a hub
HUB_SHARE = 1_000


def _with_low(rows: DataFrame, low: DataFrame) -> DataFrame:
    """``rows`` (a, b) with the ``low`` of their a.  ``low`` (a, low, degree) is
    one row per node.  Hubs, at most ``HUB_SHARE`` nodes whatever the input, are
    broadcast and their rows stay where they are; the others are shuffled."""
    low = written(low, "low")
    ends = low.agg(F.sum("degree")).first()[0] or 0
    hub = F.col("degree") * HUB_SHARE >= ends
    hubs = F.broadcast(low.where(hub).select("a", F.col("low").alias("hub_low")))
    tagged = rows.join(hubs, "a", "left")
    others = tagged.where("hub_low is null").select("a", "b").join(low.where(~hub).select("a", "low"), "a")
    return others.union(tagged.where("hub_low is not null").select("a", "b", F.col("hub_low").alias("low")))


def hub_join(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (written; one row per ``key``, with
    the number ``weight`` of rows that hold it).  Keys of at least one in
    ``HUB_SHARE`` of these rows, so ``HUB_SHARE`` keys at most, are broadcast and
    their rows stay where they are; the others are shuffled."""
    total = table.agg(F.sum(weight)).first()[0] or 0
    hub = F.col(weight) * HUB_SHARE >= total
    hubs = table.where(hub)
    others = rows.join(F.broadcast(hubs.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hubs), key).union(others.join(table.where(~hub), key))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of u points to the smallest of u and
    its neighbours.  Small star: u and its smaller neighbours do."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"), F.count("*").alias("degree"))
        out = _with_low(both.where("b > a"), low).select(F.col("b").alias("a"), F.col("low").alias("b"))
        return out.where("a <> b")
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("degree"))
    out = (_with_low(down, low)
           .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                                     F.struct(F.col("a"), F.col("low").alias("b")))).alias("e"))
           .select("e.a", "e.b"))
    return out.where("a <> b").distinct()


def _broadcast_round(links: DataFrame) -> DataFrame:
    """A large star and a small star over ``links`` (b < a), by broadcasts of the
    nodes' minima.  Every link gives one link; repeats stay."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    large = links.join(F.broadcast(low.toDF("b", "low")), "b").select("a", F.col("low").alias("b"))
    low = large.groupBy("a").agg(F.min("b").alias("low"))
    return (large.join(F.broadcast(low), "a")
            .select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")))


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every node points to one other node at most, and to none that
    points on (one aggregate); repeated links count once."""
    ends = (links.select(F.col("a").alias("node"), F.col("b").alias("to"), F.lit(0).alias("target"))
            .union(links.select("b", F.lit(None).cast("long"), F.lit(1))))
    node = ends.groupBy("node").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.max("target").alias("target"))
    return node.where("lo <> hi or (lo is not null and target = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node that has a link, with the smallest node that it
    reaches.  ``links`` has bigint columns a, b; direction and repeats don't
    matter; loops and nulls are ignored.  No links give no rows."""
    links = written(links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
                    .where("a <> b"), "links")
    ends = 2 * links.count()
    if ends > BROADCAST_NODES:
        links = written(links.distinct(), "links")
        ends = 2 * links.count()
    while ends:
        if ends <= BROADCAST_NODES:
            links = written(_broadcast_round(links), "links")
        else:
            links = written(_star(written(_star(links, True), "links"), False), "links")
            ends = 2 * links.count()
        if _is_star_forest(links):
            break
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


def shared_id_links(members: DataFrame) -> DataFrame:
    """(a, b): links between the nodes of ``members`` (id, node) that share an id."""
    several = (members.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("high"))
               .where("b <> high").select("id", "b"))
    return members.join(several, "id").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
