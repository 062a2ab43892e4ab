"""Hard negatives by an inverted multi-index with certified windows.

Each vector is cut into two halves and each half has a codebook of its own; a
pair of codes is a cell.  The inner product of an anchor with any row of a cell
is at most the sum of two half bounds, ``<a, centre> + |a| * radius``.  Cells
are gathered into shards of bounded size (a large cell is cut into several),
and an anchor is sent

1. to the shard of its best bound, where it finds first results, and
2. to every other shard whose bound reaches what it still needs.

Inside a shard a multi-sequence heap visits the cells by falling sum of the
half bounds; a window (the k highest scores between a least and a greatest
score) is certified when the next bound is below its k-th score, and the visit
stops when all windows are.  So results are exact, whatever the codebooks; bad
ones only cost time.  Positives are a window without limits among the rows of
the anchor's label, and each positive's negatives are a window among the rows of
other labels.

The codebooks are fitted on a bounded sample and all rows are indexed.  The
broadcast index has at most ``MAX_CODES`` squared cells for each of
``MAX_DIMS`` vector lengths; rows of further lengths share ``REST`` cells.
Anchors meet shards in blocks of at most about ``ANCHOR_BLOCK``; a task holds a
shard and a block.

Defined results: a row with a null id, a null label, a null vector, or a null or
non-finite component (after scaling too) takes no part; of rows that share an
id, the one with the smallest label, then vector, does; vectors of different
length never meet; an empty vector scores 0; scores beyond the range of a long
are held at its ends; equal scores go by the smaller id; other columns are
ignored; empty input gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.scratch import written

#: documented bounds of the codebook fit; every row is indexed
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 32 << 20
CELL_ROWS = 256
MAX_CODES = 64
MAX_DIMS = 8
REST = 64
SHARD_ROWS = 8_192
ANCHOR_BLOCK = 4_096
FIRST_ROWS = 512

_LOW, _HIGH = -2**63, 2**63 - 1


def fit_codes(x: np.ndarray, codes: int, rounds: int = 6, seed: int = 13) -> np.ndarray:
    """Centres of k-means of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), size=min(codes, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centre)
        size = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre[size > 0] = total[size > 0] / size[size > 0, None]
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre**2).sum(axis=1) - 2 * x @ centre.T, axis=1)


def pack(x: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as bytes: four a component where they fit, else eight."""
    small = np.abs(x).max(axis=1, initial=0) < 2**24
    return [(row.astype(np.float32) if s else row).tobytes() for row, s in zip(x, small)]


def unpack(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(rows), dim))
    for i, raw in enumerate(rows):
        out[i] = np.frombuffer(raw, np.float32 if len(raw) == 4 * dim else np.float64)
    return out


def whole_scores(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows: doubles where these are
    exact, else Python integers."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(a).max(initial=0)) * max(1, len(a)) < 2**53:
        return x @ a
    whole = [int(e) for e in a]
    exact = [sum(int(p) * q for p, q in zip(row, whole)) for row in x]
    return np.array([min(max(s, _LOW), _HIGH) for s in exact], dtype=object)


@dataclass
class Space:
    """Cells of the vectors of one length (or, without codes, of several)."""
    codes: tuple[np.ndarray, np.ndarray] | None
    cells: np.ndarray | None = None    # cell numbers present, ascending
    radius: np.ndarray | None = None   # (cells, 2)
    group: np.ndarray | None = None    # start of each run of cells that share their shards
    first: np.ndarray | None = None    # of each run: its first shard
    parts: np.ndarray | None = None    # of each run: its number of shards

    @np.errstate(over="ignore", invalid="ignore")
    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance to its two half centres, per row; a distance that
        overflows is infinite, and its cell is always visited."""
        half = x.shape[1] // 2
        if self.codes is None:
            away = np.stack([np.linalg.norm(h, axis=1) for h in (x[:, :half], x[:, half:])], axis=1)
            return np.zeros(len(x), np.int64), away
        cell, away = np.zeros(len(x), np.int64), []
        for h, centre in zip((x[:, :half], x[:, half:]), self.codes):
            near = _nearest(h, centre)
            away.append(np.linalg.norm(h - centre[near], axis=1))
            cell = cell * len(centre) + near
        away = np.stack(away, axis=1)
        return cell, np.where(np.isnan(away), np.inf, away)

    @np.errstate(over="ignore", invalid="ignore")
    def half_bounds(self, a: np.ndarray, code: np.ndarray, radius: np.ndarray, side: int) -> np.ndarray:
        """Greatest half product of each row of ``a`` with any half vector
        within ``radius`` of its centre ``code``, a little rounded up."""
        half = a.shape[1] // 2
        h = a[:, half:] if side else a[:, :half]
        size = np.linalg.norm(h, axis=1)[:, None]
        if self.codes is None:
            bound = size * radius * (1 + 1e-9) + 1e-3
        else:
            centre = self.codes[side][code]
            reach = size * (np.linalg.norm(centre, axis=1) + radius)
            bound = h @ centre.T + size * radius + 1e-9 * reach + 1e-3
        return np.where(np.isnan(bound), np.inf, bound)

    def split(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.codes[1]) if self.codes else 1
        return cells // n, cells % n

    def run_bounds(self, a: np.ndarray) -> np.ndarray:
        """(anchors, runs): upper bounds of the scores in each run's shards."""
        one, two = self.split(self.cells)
        bound = self.half_bounds(a, one, self.radius[:, 0], 0) + self.half_bounds(a, two, self.radius[:, 1], 1)
        return np.maximum.reduceat(bound, self.group, axis=1)


def space_of(dim: int, fitted: dict[int, Space]) -> int:
    return dim if dim in fitted else -1 - dim % REST


def _fit(rows: DataFrame) -> dict[int, Space]:
    """Codebooks for the commonest vector lengths, from a bounded sample."""
    spaces = {}
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(MAX_DIMS)
    for dim, n in [tuple(r) for r in common.collect()]:
        codes = min(MAX_CODES, int(np.sqrt(n / CELL_ROWS)) + 1)
        if dim < 2 or codes < 2:
            continue
        most = min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim))
        share = 0.9 * most / n
        pick = rows.where(F.col("dim") == dim)
        if share < 1:
            pick = pick.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
        x = [r.as_py() for r in pick.select("v").limit(most).toArrow().column("v")]
        if len(x) >= codes:
            x = np.array(x, np.float64)
            spaces[dim] = Space((fit_codes(x[:, :dim // 2], codes), fit_codes(x[:, dim // 2:], codes)))
    return spaces


def _place(rows: DataFrame, fitted: dict[int, Space]) -> DataFrame:
    plain = Space(None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = np.asarray(part.column("v").flatten(), dtype=np.float64).reshape(part.num_rows, dim)
                cell, away = fitted.get(dim, plain).encode(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), part.column("dim"),
                     pa.array(np.full(len(x), space_of(dim, fitted)), pa.int32()), pa.array(cell, pa.int32()),
                     pa.array(away[:, 0]), pa.array(away[:, 1]), pa.array(pack(x), pa.binary())],
                    names=["vec_id", "label", "dim", "space", "cell", "r1", "r2", "q"])

    return rows.select("vec_id", "label", "dim", "v").mapInArrow(
        run, "vec_id long, label long, dim int, space int, cell int, r1 double, r2 double, q binary")


def build_index(placed: DataFrame, fitted: dict[int, Space], shard_rows: int) -> tuple[dict[int, Space], list[tuple]]:
    """(spaces, cell map): the cells' radii, and (space, cell, first shard,
    parts) for each cell.  One row per cell comes to the driver, at most
    ``MAX_DIMS * MAX_CODES**2 + REST``."""
    table = (placed.groupBy("space", "cell").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2"))
             .orderBy("space", "cell").collect())
    spaces, cell_map, shard = {}, [], 0
    for key in sorted({r.space for r in table}):
        own = [r for r in table if r.space == key]
        starts, firsts, parts, room = [], [], [], 0
        for i, r in enumerate(own):
            if not starts or r.n > room:
                shard += parts[-1] if parts else 0
                starts.append(i)
                firsts.append(shard)
                parts.append(-(-r.n // shard_rows))
                room = max(0, shard_rows - r.n)      # a cut cell shares its shards with none
            else:
                room -= r.n
            cell_map.append((key, r.cell, firsts[-1], parts[-1]))
        shard += parts[-1]
        spaces[key] = Space(fitted[key].codes if key in fitted else None, np.array([r.cell for r in own]),
                            np.array([[r.r1, r.r2] for r in own]), np.array(starts), np.array(firsts), np.array(parts))
    return spaces, cell_map


def _requests(anchors: DataFrame, index, home: bool) -> DataFrame:
    """A row per anchor and shard to visit: its best one (``home``), or all
    others whose bound reaches the least score that it still needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, spaces = np.asarray(batch.column("dim")), np.asarray(batch.column("space"))
            for dim in np.unique(dims).tolist():
                of_dim = np.flatnonzero(dims == dim)
                space = index.value[int(spaces[of_dim[0]])]
                for lo in range(0, len(of_dim), 256):
                    part = batch.take(pa.array(of_dim[lo:lo + 256]))
                    bound = space.run_bounds(unpack(part.column("q").to_pylist(), dim))
                    best = np.argmax(bound, axis=1)
                    if home:
                        row, shard = np.arange(len(best)), space.first[best]
                    else:
                        least = np.array([min(x, default=_HIGH) for x in part.column("need").to_pylist()], np.float64)
                        row, run_ = np.nonzero(bound >= least[:, None])
                        times = space.parts[run_]
                        shard = np.repeat(space.first[run_], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                        row = np.repeat(row, times)
                        other = shard != space.first[best[row]]
                        row, shard = row[other], shard[other]
                    asked = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard, pa.int32()), *[asked.column(c) for c in ("vec_id", "label", "dim", "q", "high", "need")]],
                        names=["shard", "vec_id", "label", "dim", "q", "high", "need"])

    return anchors.mapInArrow(run, "shard int, vec_id long, label long, dim int, q binary, high array<long>, need array<long>")


class _Window:
    """The k best (score, id) with scores from ``need`` to ``high``."""

    def __init__(self, high: int, need: int, k: int):
        self.high, self.need, self.k, self.best = high, need, k, []

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        fits = np.flatnonzero((score <= self.high) & (score >= self.need))
        if len(fits):
            if len(fits) > 4 * self.k and score.dtype != object:
                least = np.partition(score[fits], -self.k)[-self.k]
                fits = fits[score[fits] >= least]
            rows = self.best + [(-int(score[i]), int(ids[i])) for i in fits]
            self.best = heapq.nsmallest(self.k, rows)
            if len(self.best) == self.k:
                self.need = max(self.need, -self.best[-1][0])


def visit_cells(space: Space, a: np.ndarray, cells: np.ndarray, radius: np.ndarray) -> Iterator[tuple[int, float]]:
    """(cell position, bound) by falling sum of the half bounds, by a heap over
    both sorted halves; bounds of later cells are never greater."""
    one, two = space.split(cells)
    at = {(i, j): n for n, (i, j) in enumerate(zip(one.tolist(), two.tolist()))}
    sides = []
    for side, code in ((0, one), (1, two)):
        known = np.unique(code)
        far = np.zeros(len(known))
        np.maximum.at(far, np.searchsorted(known, code), radius[:, side])
        bound = space.half_bounds(a[None, :], known, far, side)[0]
        order = np.argsort(-bound, kind="stable")
        sides.append((known[order].tolist(), bound[order].tolist()))
    (codes1, bound1), (codes2, bound2) = sides
    heap = [(-(bound1[0] + bound2[0]), 0, 0)]
    while heap:
        b, p, q = heapq.heappop(heap)
        if (codes1[p], codes2[q]) in at:
            yield at[codes1[p], codes2[q]], -b
        if q + 1 < len(codes2):
            heapq.heappush(heap, (-(bound1[p] + bound2[q + 1]), p, q + 1))
        if q == 0 and p + 1 < len(codes1):
            heapq.heappush(heap, (-(bound1[p + 1] + bound2[0]), p + 1, 0))


def search_shard(space: Space, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray, radius: np.ndarray,
                 a: np.ndarray, anchor: int, label: int, windows: list[_Window], same: bool) -> None:
    """Offer the windows all rows of a shard that can matter to them.  Rows are
    sorted by cell; cells are scored in growing lots."""
    known, start = np.unique(cells, return_index=True)
    end = np.append(start[1:], len(cells))
    far = np.maximum.reduceat(radius, start, axis=0)
    lot, rows, size = [], 0, FIRST_ROWS

    def score() -> None:
        take = np.concatenate([np.arange(start[c], end[c]) for c in lot])
        s = whole_scores(x[take], a)
        of = labels[take] == label if same else labels[take] != label
        if same:
            of &= ids[take] != anchor
        keep = np.flatnonzero(of & (s >= min(w.need for w in windows)))
        if len(keep):
            for w in windows:
                w.offer(s[keep], ids[take[keep]])

    for c, bound in visit_cells(space, a, known, far):
        if bound < min(w.need for w in windows):
            break
        lot.append(c)
        rows += end[c] - start[c]
        if rows >= size:
            score()
            lot, rows, size = [], 0, 2 * size
    if lot:
        score()


def _search(index, same: bool, k: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        dims = np.asarray(left.column("dim"))
        for request in right.to_pylist():
            if not request["high"]:
                continue
            dim = request["dim"]
            if dim not in held:
                own = left.filter(pa.array(dims == dim))
                cells = np.asarray(own.column("cell"))
                own, cells = own.take(pa.array(np.argsort(cells, kind="stable"))), np.sort(cells, kind="stable")
                held[dim] = (unpack(own.column("q").to_pylist(), dim), np.asarray(own.column("vec_id")),
                             np.asarray(own.column("label")), cells,
                             np.stack([np.asarray(own.column("r1")), np.asarray(own.column("r2"))], axis=1),
                             own.column("space")[0].as_py() if own.num_rows else None)
            x, ids, labels, cells, radius, space = held[dim]
            if not len(x):
                continue
            windows = [_Window(h, n, k) for h, n in zip(request["high"], request["need"])]
            search_shard(index.value[space], x, ids, labels, cells, radius, unpack([request["q"]], dim)[0],
                         request["vec_id"], request["label"], windows, same)
            for w, window in enumerate(windows):
                for s, i in window.best:
                    for col, v in zip(out, (request["vec_id"], w, i, -s)):
                        col.append(v)
        held.clear()
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                        names=["anchor_id", "w", "vec_id", "score"])
    held: dict = {}
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(rows: DataFrame, anchors: DataFrame, index, same: bool, k: int, blocks: int) -> DataFrame:
    """(anchor_id, w, vec_id, score, rank): the k best rows of each window of
    ``anchors`` (vec_id, label, dim, space, q, high, need)."""
    def visit(asked: DataFrame) -> DataFrame:
        asked = written(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "requests")
        met = asked.select(F.col("shard").alias("visited"), F.col("block").alias("by")).distinct()
        dealt = rows.join(met, F.col("shard") == F.col("visited"))
        found = (dealt.groupBy("visited", "by").cogroup(asked.groupBy("shard", "block"))
                 .applyInArrow(_search(index, same, k), "anchor_id long, w int, vec_id long, score long"))
        return written(found, "found")

    first = visit(_requests(anchors, index, True))
    # what a window needs after the first shard: its k-th score there
    got = (first.groupBy("anchor_id", "w").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") == k)
           .groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kth")))
    more = anchors.join(got, anchors["vec_id"] == got["anchor_id"], "left")
    need = F.transform("need", lambda n, w: F.coalesce(F.greatest(n, F.col("kth")[w]), n))
    rest = visit(_requests(more.select("vec_id", "label", "dim", "space", "q", "high", need.alias("need")), index, False))
    return _best(first.union(rest), k)


def usable(vectors: DataFrame, scale: float) -> DataFrame:
    """(vec_id, label, dim, v): the rows that take part, components floored."""
    e = F.col("embedding").cast("array<double>")
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    one = (vectors.where("vec_id is not null and label is not null and embedding is not null")
           .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.alias("e"), good.alias("good"))
           .where("good").groupBy("vec_id").agg(F.min(F.struct("label", "e")).alias("r")))

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("e")
            flat = pa.array(np.floor(np.asarray(v.flatten(), dtype=np.float64) * scale) + 0.0)
            size = np.asarray(v.value_lengths())
            v = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(size, pa.int32()), v],
                                             names=["vec_id", "label", "dim", "v"])

    return one.select("vec_id", "r.label", "r.e").mapInArrow(floored, "vec_id long, label long, dim int, v array<double>")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80,
                   scale: float = 256.0, shard_rows: int = SHARD_ROWS, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows of ``vectors`` (vec_id, label, embedding) that
    are anchors: the nearest ``positives`` rows of the label, and for each the
    nearest ``negatives`` rows of other labels that score no more than it and at
    least ``least_percent`` of it.  A score is the inner product of
    ``floor(scale * component)``."""
    spark = vectors.sparkSession
    rows = written(usable(vectors, scale), "vectors")
    fitted = _fit(rows)
    placed = written(_place(rows, fitted), "cells")
    spaces, cell_map = build_index(placed, fitted, shard_rows)
    index = spark.sparkContext.broadcast(spaces)
    cells = spark.createDataFrame(cell_map, "space int, cell int, first int, parts int")   # bounded, see build_index
    shard = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    dealt = written(placed.join(F.broadcast(cells), ["space", "cell"]).withColumn("shard", shard).drop("first", "parts"), "shards")

    anchors = placed.where(is_anchor).select("vec_id", "label", "dim", "space", "q")
    blocks = max(1, -(-anchors.count() // anchor_block))
    open_window = anchors.withColumns({"high": F.array(F.lit(_HIGH)), "need": F.array(F.lit(_LOW))})
    near = written(search(dealt, open_window, index, True, positives, blocks)
                   .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                           (F.col("rank") - 1).alias("w")), "positives")
    # ceil(least_percent * score / 100) without overflow: whole hundreds and the rest apart
    score, hundreds = F.col("positive_score"), F.expr("positive_score div 100")
    floor_ = hundreds * least_percent + F.ceil((score - hundreds * 100) * least_percent / 100)
    limits = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("w", score.alias("high"), floor_.alias("need")))).alias("ws"))
    windows = anchors.join(limits, anchors["vec_id"] == limits["anchor_id"]).select(
        "vec_id", "label", "dim", "space", "q", F.col("ws.high").alias("high"), F.col("ws.need").alias("need"))
    hard = search(dealt, windows, index, False, negatives, blocks).withColumnRenamed("score", "negative_score")
    return hard.join(near, ["anchor_id", "w"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", "negative_score")
