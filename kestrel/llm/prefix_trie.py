"""Prefix trie of conversations, by union-find over sorted neighbours.

Every turn is reduced to 16 bytes, and a conversation to the string of its
turns' bytes, so that conversations with a common opening are neighbours in
byte order.  Equal conversations are one sequence with a count.  The distinct
sequences are range-partitioned and sorted; each range is taken block by block:

* the edges between sorted neighbours carry the turns that both share; they
  are processed from the deepest to the shallowest by union-find, and every
  merge of components makes (or widens) a branching node of that depth;
* nodes that lie neither on the first nor on the last sequence of the block
  can't reach beyond it: they are finished, and their whole chains of single
  children are written out;
* what stays open, the paths of the first and the last sequence, is the
  block's contracted forest.  Neighbouring forests are merged by union-find
  over the turns shared across the boundary, again from the deepest up: block
  by block inside a range, then ``FAN_IN`` ranges at a time until one is left.

A forest has as many open nodes as its two outer sequences have turns, so a
task's memory depends on a block and on the longest conversations, not on how
many conversations share an opening.  A first turn that all share, or a
conversation logged a million times, is one path like any other.  The ids that
end at a node are packed in sorted runs and hashed as a stream.

One conversation is one row: 20 bytes a turn (its texts don't move with it).

Defined results: turns are ordered by ``turn`` (null first), then role, then
MD5 of role and text; a null role or text counts as empty; repeated rows are
turns like others; rows without ``conv_id`` belong to no conversation; a block
of conversations starts at ``conv_id - conv_id % block`` with SQL's remainder;
other columns are ignored; a table without conversations gives no rows, not
even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.scratch import written

WIDTH = 16                 # bytes of a turn
BLOCK_ROWS = 8_192
BLOCK_BYTES = 4 << 20
PACK_BYTES = 64 << 10
FAN_IN = 32

_VALUES = ("n", "conv", "chars", "kids", "leaves", "saved")
_NODE = [("part", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
         ("parent_key", pa.binary()), ("node_key", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string())]
_SPINE = [("first", pa.binary()), ("last", pa.binary()), *[(f"s_{v}", pa.list_(pa.int64())) for v in _VALUES],
          ("s_ends", pa.list_(pa.string()))]
_SCHEMA = pa.schema(_NODE + _SPINE)
_DDL = ("part long, conv_id long, depth long, parent_conv_id long, parent_key binary, node_key binary, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, ends string, first binary, last binary, "
        + ", ".join(f"s_{v} array<long>" for v in _VALUES) + ", s_ends array<string>")


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from their start."""
    lo, hi = 0, min(len(a), len(b)) // WIDTH
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * WIDTH:mid * WIDTH] == b[lo * WIDTH:mid * WIDTH]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def prefix_keys(seq: bytes) -> list[bytes]:
    """MD5 of each prefix of 0, 1, ... turns."""
    h = hashlib.md5()
    out = [h.digest()]
    for i in range(0, len(seq), WIDTH):
        h.update(seq[i:i + WIDTH])
        out.append(h.copy().digest())
    return out


@dataclass
class Spine:
    """A contracted forest: the open nodes on the paths of the first and the
    last sequence, by depth; both paths share their first nodes.  A node is
    [n, conv, chars, kids, leaves, saved, ends]; the last four count what is
    finished below it."""
    first: bytes
    last: bytes
    left: list[list]
    right: list[list]


@dataclass
class Output:
    """Finished nodes (columns of ``_NODE``) of one range."""
    part: int
    rows: list[tuple] = field(default_factory=list)

    def batches(self, spine: Spine | None = None, size: int = 50_000) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.rows), size):
            cols = list(zip(*self.rows[lo:lo + size]))
            n = len(cols[0])
            arrays = [pa.array(c, t) for c, (_, t) in zip(cols, _NODE)]
            yield pa.RecordBatch.from_arrays(arrays + [pa.nulls(n, t) for _, t in _SPINE], schema=_SCHEMA)
        self.rows = []
        if spine:
            shared = shared_turns(spine.first, spine.last) + 1
            nodes = spine.left + spine.right[shared:]
            lists = [[node[i] for node in nodes] for i in range(7)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.part], pa.int64())] + [pa.nulls(1, t) for _, t in _NODE[1:]]
                + [pa.array([v], t) for v, (_, t) in zip([spine.first, spine.last, *lists], _SPINE)], schema=_SCHEMA)


def read_spine(row: dict) -> Spine:
    nodes = [list(v) for v in zip(*[row[f"s_{v}"] for v in _VALUES], row["s_ends"])]
    shared = shared_turns(row["first"], row["last"]) + 1
    left = nodes[:len(row["first"]) // WIDTH + 1]
    return Spine(row["first"], row["last"], left, left[:shared] + nodes[len(left):])


def _find(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def block_forest(seqs: list[bytes], lens: list[np.ndarray], convs: list[int], counts: list[int],
                 ends: list[str], out: Output) -> Spine:
    """Write the finished nodes of a block of sorted distinct sequences, and
    return what stays open."""
    m = len(seqs)
    depth = [len(s) // WIDTH for s in seqs]
    n, conv, end, member = list(counts), list(convs), list(ends), list(range(m))
    parent = [-1] * m
    opens = [i in (0, m - 1) for i in range(m)]     # lies on an outer path
    edge = np.array([shared_turns(a, b) for a, b in zip(seqs, seqs[1:])], np.int64)
    up, top = list(range(m)), list(range(m))
    for i in np.argsort(-edge, kind="stable").tolist():
        a, b, x = _find(up, i), _find(up, i + 1), int(edge[i])
        ta, tb = top[a], top[b]
        if depth[ta] == x or depth[tb] == x:
            node, kids = (ta, (tb,)) if depth[ta] == x else (tb, (ta,))
        else:
            node, kids = len(depth), (ta, tb)
            depth.append(x)
            n.append(0)
            conv.append(conv[ta])
            end.append(None)
            member.append(member[ta])
            parent.append(-1)
            opens.append(False)
        for k in kids:
            parent[k] = node
            n[node] += n[k]
            conv[node] = min(conv[node], conv[k])
            opens[node] |= opens[k]
        up[b] = a
        top[a] = node
    on_first, on_last = _ancestors(parent, 0), _ancestors(parent, m - 1)
    left: list = [None] * (depth[0] + 1)
    right: list = [None] * (depth[m - 1] + 1)
    keys = {}
    kids, leaves, saved = [0] * len(depth), [0] * len(depth), [0] * len(depth)
    for v in sorted(range(len(depth)), key=depth.__getitem__, reverse=True):
        p = parent[v]
        stop = depth[p] if p >= 0 else -1
        chars = lens[member[v]]
        if opens[v]:
            for d in range(depth[v], stop, -1):
                own = d == depth[v]
                node = [n[v], conv[v], int(chars[d - 1]) if d else 0, kids[v] if own else 0, leaves[v] if own else 0,
                        saved[v] if own else 0, end[v] if own else None]
                if v in on_first:
                    left[d] = node
                if v in on_last:
                    right[d] = node
            continue
        total, below = saved[v], max(1, leaves[v])
        for d in range(depth[v], stop, -1):
            total += (n[v] - 1) * int(chars[d - 1])
            own, at_top = d == depth[v], d == stop + 1
            key = None
            if at_top and opens[p]:
                side = 0 if p in on_first else m - 1
                if side not in keys:
                    keys[side] = prefix_keys(seqs[side])
                key = keys[side][stop]
            out.rows.append((out.part, conv[v], d, None if key else conv[p] if at_top else conv[v], key, None, n[v],
                             kids[v] if own else 1, below, total, end[v] if own else None))
        kids[p] += 1
        leaves[p] += below
        saved[p] += total
    return Spine(seqs[0], seqs[-1], left, right)


def _ancestors(parent: list[int], v: int) -> set[int]:
    out = set()
    while v >= 0:
        out.add(v)
        v = parent[v]
    return out


def merge_spines(spines: list[Spine], out: Output, last_merge: bool) -> Spine | None:
    """Merge neighbouring forests in order; write the nodes that are finished
    by it (all of them in the ``last_merge``), and return what stays open."""
    nodes: list[list] = []
    depth: list[int] = []
    above: list[int] = []
    keys: list[bytes] = []
    lefts, rights = [], []
    for s in spines:
        shared = shared_turns(s.first, s.last) + 1
        ids = list(range(len(nodes), len(nodes) + len(s.left)))
        lefts.append(ids)
        nodes += [list(v) for v in s.left]
        depth += range(len(s.left))
        above += [-1, *ids[:-1]]
        keys += prefix_keys(s.first)
        more = list(range(len(nodes), len(nodes) + len(s.right) - shared))
        rights.append(ids[:shared] + more)
        nodes += [list(v) for v in s.right[shared:]]
        depth += range(shared, len(s.right))
        above += rights[-1][shared - 1:-1] if more else []
        keys += prefix_keys(s.last)[shared:]
    up = list(range(len(nodes)))
    for j in range(len(spines) - 1):
        for d in range(shared_turns(spines[j].last, spines[j + 1].first), -1, -1):
            a, b = _find(up, rights[j][d]), _find(up, lefts[j + 1][d])
            if a == b:
                continue
            up[b] = a
            x, y = nodes[a], nodes[b]
            x[0] += y[0]
            x[1] = min(x[1], y[1])
            for i in (3, 4, 5):
                x[i] += y[i]
            x[6] = x[6] or y[6]
    first, last = [_find(up, i) for i in lefts[0]], [_find(up, i) for i in rights[-1]]
    opens = set() if last_merge else {*first, *last}
    for v in sorted((i for i in range(len(nodes)) if up[i] == i), key=depth.__getitem__, reverse=True):
        if v in opens:
            continue
        n, conv, chars, kids, leaves, saved, end = nodes[v]
        saved, leaves = saved + (n - 1) * chars, max(1, leaves)
        p = _find(up, above[v]) if depth[v] else -1
        unknown = p in opens
        out.rows.append((out.part, conv, depth[v], None if unknown or p < 0 else nodes[p][1], keys[p] if unknown else None,
                         keys[v], n, kids, leaves, saved, end))
        if p >= 0:
            nodes[p][3] += 1
            nodes[p][4] += leaves
            nodes[p][5] += saved
    if last_merge:
        return None
    return Spine(spines[0].first, spines[-1].last, [nodes[i] for i in first], [nodes[i] for i in last])


def rebuilt(conversations: DataFrame, block: int = 100, turns: Callable[[Column], Column] | None = None,
            most: int = 5) -> DataFrame:
    """(conv_id, seq, lens): each conversation as the bytes of its turns and
    their lengths in code points, its first ``turns(conv_id)`` turns (at most
    ``most``) replaced by those of the conversation that starts its block.
    Without ``turns`` conversations stay as they are."""
    role, text, conv = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")), F.col("conv_id").cast("long")
    mark = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = (conversations.where("conv_id is not null")
            .select(conv.alias("conv_id"), (conv - conv % block).alias("head"),
                    F.struct(F.col("turn").alias("turn"), role.alias("role"), mark.alias("mark"),
                             F.length(text).alias("chars")).alias("t")))
    # a block is at most 2 * block - 1 conversations, whatever the table's size
    own = (rows.repartition("head").groupBy("head", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own")))
    if turns is None:
        full = F.col("own")
    else:
        given = F.max(F.when(F.col("conv_id") == F.col("head"), F.slice("own", 1, most))).over(Window.partitionBy("head"))
        own = own.withColumn("given", given).withColumn("h", turns(F.col("conv_id")).cast("int"))
        full = F.concat(F.coalesce(F.slice("given", F.lit(1), F.col("h")), F.slice("own", F.lit(1), F.lit(0))),
                        F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))))
    return (own.select("conv_id", full.alias("full"))
            .select("conv_id", F.unhex(F.array_join(F.col("full.mark"), "")).alias("seq"), F.col("full.chars").alias("lens")))


def end_digests(members: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ids of each key in ascending order, comma
    between.  Ids are packed in sorted runs before they meet, and the runs of a
    key are hashed as a stream: no list of a key's ids is ever held."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, low, ids, size = None, 0, [], 0
        for batch in batches:
            keys, rows = [], []
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or size >= PACK_BYTES):
                    keys.append((key, low))
                    rows.append(",".join(ids))
                    ids, size = [], 0
                if not ids:
                    key, low = k, c
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if keys:
                yield packed(keys, rows)
        if ids:
            yield packed([(key, low)], [",".join(ids)])

    def packed(keys: list[tuple], rows: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.string()), pa.array([c for _, c in keys], pa.int64()),
                                           pa.array(rows, pa.string())], names=["key", "low", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, ends = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        ends.append(state.hexdigest())
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ends, pa.string())], names=["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([state.hexdigest()], pa.string())],
                                             names=["key", "ends"])

    runs = (members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
            .mapInArrow(pack, "key string, low long, ids string"))
    return runs.repartition("key").sortWithinPartitions("key", "low").mapInArrow(digest, "key string, ends string")


def _range_forest(block_rows: int, block_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        out = Output(TaskContext.get().partitionId())
        spine, held, size = None, [], 0

        def close() -> None:
            nonlocal spine, held, size
            block = block_forest(*[list(c) for c in zip(*held)], out)
            spine = merge_spines([spine, block], out, False) if spine else block
            held, size = [], 0

        for batch in batches:
            lens = batch.column(1)
            at, flat = np.asarray(lens.offsets), np.asarray(lens.values)
            rows = zip(batch.column(0).to_pylist(), [flat[a:b] for a, b in zip(at, at[1:])],
                       *[batch.column(i).to_pylist() for i in (2, 3, 4)])
            for row in rows:
                held.append(row)
                size += len(row[0])
                if len(held) >= block_rows or size >= block_bytes:
                    close()
                    yield from out.batches()
        if held:
            close()
        yield from out.batches(spine)
    return run


def _merge_group(last_merge: bool, level: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        out = Output((level << 40) | rows[0]["part"] // FAN_IN)
        spine = merge_spines([read_spine(r) for r in rows], out, last_merge)
        return pa.Table.from_batches(list(out.batches(spine)), schema=_SCHEMA)
    return run


def prefix_trie(members: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The trie's nodes of ``members`` (conv_id, seq, lens), a row each:
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (length of the node's last text for each member but
    one, summed over the subtree), ends_sha256 (of the ids that end here)."""
    members = written(members.withColumn("key", F.md5("seq")), "sequences")
    classes = (members.groupBy("key", "seq", "lens").agg(F.min("conv_id").alias("conv"), F.count("*").alias("n"))
               .join(end_digests(members), "key"))
    forests = written(classes.select("seq", "lens", "conv", "n", "ends").repartitionByRange("seq").sortWithinPartitions("seq")
                      .mapInArrow(_range_forest(block_rows, block_bytes), _DDL), "forests")
    nodes, level = forests.where("depth is not null"), 0
    spines = forests.where("depth is null")
    while (high := spines.agg(F.max(F.col("part").bitwiseAND((1 << 40) - 1))).first()[0]) is not None:
        level += 1
        part = F.col("part").bitwiseAND((1 << 40) - 1)
        merged = written(spines.withColumn("part", part).groupBy(F.floor(F.col("part") / FAN_IN).alias("g"))
                         .applyInArrow(_merge_group(high < FAN_IN, level), _DDL), "forests")
        nodes = nodes.union(merged.where("depth is not null"))
        spines = merged.where("depth is null")
        if high < FAN_IN:
            break
    # a finished node below an open one learns the smallest member of that one
    # when it is finished too; looked up once per range, so that no range of
    # rows meets the other children of a common opening
    known = nodes.where("node_key is not null").select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("found"))
    asked = nodes.where("parent_key is not null")
    answers = asked.select("part", "parent_key").distinct().join(known, "parent_key")
    done = nodes.where("parent_key is null")
    rest = asked.join(answers, ["part", "parent_key"]).withColumn("parent_conv_id", F.col("found"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    return (done.select(columns).union(rest.select(columns))
            .withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256))).drop("ends"))


def shared_opening(block: int = 6) -> Callable[[Column], Column]:
    """Turns taken from the block's first conversation: crc32 of the id."""
    return lambda conv_id: F.crc32(conv_id.cast("string").cast("binary")) % block
