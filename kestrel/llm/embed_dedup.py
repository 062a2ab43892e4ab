"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Centroids are fitted on a bounded sample; every vector is then assigned to its
nearest one.  Two vectors of cosine c lie at most ``r = sqrt(2 - 2c)`` apart,
and the distances of the two to the plane between their cells add up to no
more than r.  A vector within r / 2 of the plane to another cell is therefore
also sent there as a visitor, and no link between cells is missed: recall is
exact whatever the centroids.

Inside a cell, residents are cut into blocks; a block meets each block of
residents and visitors in a task of its own, as matrix products of a slice of
rows with the other block.  Tasks return a count per vector and a spanning star
of the links they found, never the pairs.  Vectors that are equal in every
component form one class first, so a group of copies of any size is one row
here.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component, a null label, or a null id is linked with nothing; very
large and very small components don't overflow; vectors of different length are never linked; rows that share an id are one
vector with all their links; other columns are ignored; empty input gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.graph import components, shared_id_links
from kestrel.llm.scratch import written

#: documented bound of the centroid fit; every vector is assigned and compared
SAMPLE_ROWS = 20_000
CELL_ROWS = 1_000
BLOCK_ROWS = 1_024
#: rows of a block that are compared with the other block at once
SLICE_ROWS = 256
MAX_CELLS = 1_024


def fit_cells(vectors: np.ndarray, cells: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means: unit centroids of unit ``vectors``."""
    rng = np.random.default_rng(seed)
    centre = vectors[rng.choice(len(vectors), size=min(cells, len(vectors)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(vectors @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, vectors)
        size = np.linalg.norm(total, axis=1)
        centre[size > 1e-12] = total[size > 1e-12] / size[size > 1e-12, None]
    return np.unique(centre, axis=0)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; each row is first scaled by a power of two, which
    changes no digit, so that no square over- or underflows."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))
    x = np.ldexp(x, -exponent)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _visits(x: np.ndarray, centre: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell per row, and a boolean (row, cell): visits that cell."""
    dots = x @ centre.T
    home = np.argmax(dots, axis=1)
    gap = np.sqrt(np.maximum(2 - 2 * centre @ centre.T, 1e-18))
    margin = (dots[np.arange(len(x)), home][:, None] - dots) / gap[home]
    visits = margin <= reach + 1e-9
    visits[np.arange(len(x)), home] = False
    return home, visits


def valid_classes(vectors: DataFrame) -> DataFrame:
    """(label, dim, v, node, rows): classes of equal usable vectors of a label,
    with the smallest id and the number of rows."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return (vectors.where("vec_id is not null and label is not null and embedding is not null")
            .select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))
            .where(finite & F.exists("v", lambda e: e != 0.0))
            .withColumn("v", F.transform("v", lambda e: e + F.lit(0.0)))   # -0.0 equals 0.0
            .groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("rows"))
            .withColumn("dim", F.size("v")))


def _centroids(spark: SparkSession, classes: DataFrame, sample_rows: int, cell_rows: int) -> dict[int, np.ndarray]:
    """Centroids per vector length, from at most ``sample_rows`` vectors."""
    out = {}
    sizes = classes.groupBy("dim", "label").count().groupBy("dim").agg(F.sum("count"), F.max("count"))
    for dim, n, largest in sizes.collect():   # one row per vector length
        share = sample_rows * 0.9 / n
        pick = classes.where(F.col("dim") == dim)
        if share < 1:
            pick = pick.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20)))
        rows = pick.select("v").limit(sample_rows).toPandas()["v"]
        cells = min(MAX_CELLS, -(-largest // cell_rows))
        if len(rows):
            out[dim] = fit_cells(_unit(np.array(rows.tolist(), dtype=np.float64)), cells)
    return out


def _assign(classes: DataFrame, centre: dict[int, np.ndarray], reach: float) -> DataFrame:
    """A row per class and cell: resident (home = cell) or visitor; a resident
    lists the cells it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _unit(np.asarray(part.column("v").flatten(), dtype=np.float64).reshape(part.num_rows, dim))
                if dim in centre:
                    home, visits = _visits(x, centre[dim], reach)
                else:
                    home, visits = np.zeros(len(x), np.int64), np.zeros((len(x), 1), bool)
                row, cell = np.nonzero(visits)
                take = np.concatenate([np.arange(len(x)), row])
                lists = [np.flatnonzero(v) for v in visits] + [np.zeros(0, np.int64)] * len(row)
                picked = part.take(pa.array(take))
                yield pa.RecordBatch.from_arrays(
                    [picked.column("label"), picked.column("dim"), pa.array(np.concatenate([home, cell]), pa.int32()),
                     pa.array(home[take], pa.int32()), pa.array(lists, pa.list_(pa.int32())),
                     picked.column("node"), picked.column("rows"), picked.column("v")],
                    names=["label", "dim", "cell", "home", "visits", "node", "rows", "v"])

    schema = (f"label {classes.schema['label'].dataType.simpleString()}, dim int, cell int, home int, "
              "visits array<int>, node long, rows long, v array<double>")
    return classes.select("label", "dim", "node", "rows", "v").mapInArrow(run, schema)


def _stars(links: np.ndarray, first: np.ndarray, second: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Smallest of ``nodes`` that each row reaches over ``links``, a matrix
    between the rows ``first`` and ``second``."""
    root, top = nodes.copy(), np.iinfo(np.int64).max
    while True:
        low = root.copy()
        for at in range(0, len(first), SLICE_ROWS):
            part, rows = links[at:at + SLICE_ROWS], first[at:at + SLICE_ROWS]
            low[rows] = np.minimum(low[rows], np.where(part, root[second], top).min(axis=1))
            low[second] = np.minimum(low[second], np.where(part, root[rows][:, None], top).min(axis=0))
        if (low == root).all():
            return root
        root = low


def _compare(least: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own, other = key[-2], key[-1]
        x = _unit(np.stack(pdf["v"].to_numpy()).astype(np.float64))
        node, rows = pdf["node"].to_numpy(np.int64), pdf["rows"].to_numpy(np.int64)
        home, cell, block = pdf["home"].to_numpy(), pdf["cell"].to_numpy(), pdf["block"].to_numpy()
        resident = home == cell
        visits = pdf["visits"].to_numpy()
        goes = np.zeros((len(x), int(max(home.max(), cell.max(), *[max(v, default=0) for v in visits])) + 1), bool)
        goes[np.repeat(np.arange(len(x)), [len(v) for v in visits]), np.concatenate(visits).astype(np.int64)] = True
        first, second = np.flatnonzero(block == own), np.flatnonzero(block == other)
        links = np.zeros((len(first), len(second)), bool)
        for at in range(0, len(first), SLICE_ROWS):
            a = first[at:at + SLICE_ROWS]
            # a pair counts once: residents in their block pair, a resident and a
            # visitor in the lower of the two cells where they meet
            here, there = resident[a][:, None], resident[second]
            left = (cell[a] < home[a])[:, None] | ~goes[np.ix_(second, home[a])].T
            right = (cell[second] < home[second]) | ~goes[np.ix_(a, home[second])]
            meets = (here & there) | (here & ~there & right) | (~here & there & left)
            links[at:at + SLICE_ROWS] = meets & (x[a] @ x[second].T >= least)
        n_links = np.zeros(len(x), np.int64)
        if own == other:
            np.fill_diagonal(links, False)
            links |= links.T.copy()
        else:
            n_links[second] = rows[first] @ links
        n_links[first] = links @ rows[second]
        root = _stars(links, first, second, node)
        hit = n_links > 0
        return pd.DataFrame({"node": node[hit], "n_links": n_links[hit], "root": root[hit]})
    return run


def linked(vectors: DataFrame, least: float = 0.98, sample_rows: int = SAMPLE_ROWS,
           cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, counts, stars): classes of equal vectors, links of each class's
    vectors to other classes, and (a, b) star links that span the components."""
    spark = vectors.sparkSession
    classes = written(valid_classes(vectors), "vectors")
    reach = float(np.sqrt(2 - 2 * least)) / 2
    placed = written(_assign(classes, _centroids(spark, classes, sample_rows, cell_rows), reach), "cells")
    place = ["label", "dim", "cell"]
    size = placed.groupBy(*place).agg(F.count("*").alias("m")).withColumn(
        "blocks", F.ceil(F.col("m") / block_rows).cast("int")).drop("m")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (placed.join(size, place).withColumn("block", block)
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"lo": F.least("block", "o"), "hi": F.greatest("block", "o")}))
    found = dealt.groupBy(*place, "lo", "hi").applyInPandas(_compare(least), "node long, n_links long, root long")
    found = written(found, "links")
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    return classes, counts, found.select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.98, **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id,
    embedding, label): vectors of its label with a cosine of at least ``least``
    to it, the smallest id reachable over such links, and whether it is that."""
    classes, counts, stars = linked(vectors, least, **options)
    v = F.transform(F.col("embedding").cast("array<double>"), lambda e: e + F.lit(0.0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))
    several = written(rows.groupBy("vec_id").agg(F.min(F.xxhash64("label", "v")).alias("lo"),
                                                 F.max(F.xxhash64("label", "v")).alias("hi"))
                      .where("lo <> hi").select("vec_id"), "several")
    if not several.isEmpty():      # an id with several vectors: they belong together
        own = rows.join(several, "vec_id", "left_semi").join(classes, ["label", "v"])
        stars = stars.union(shared_id_links(own.select(F.col("vec_id").alias("id"), "node")))
    roots = components(stars)
    known = (classes.join(counts, "node", "left").join(roots, "node", "left")
             .select("label", "v", (F.coalesce("n_links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
                     F.coalesce("root", "node").alias("component_id")))
    known = written(known, "known")
    out = rows.join(known, ["label", "v"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    usable = F.col("component_id").isNotNull() & F.col("vec_id").isNotNull()
    return out.select("vec_id", F.when(usable, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
