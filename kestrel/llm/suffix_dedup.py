"""Suffix-array dedup: remove what repeats from documents of smaller id.

A byte goes if it lies in a string of ``window`` bytes that also starts in a
document with a smaller id.  Strings are judged on the input; documents are
UTF-8 bytes; nothing is matched across documents.

Sorting every suffix of a corpus in one place doesn't scale, so the suffixes
are first dealt out such that equal windows meet:

1. A window's *anchor* is the smallest hash of its 20-byte grams; neighbouring
   windows mostly share one, so a document becomes a list of short segments,
   one per anchor (about one in 16 bytes).  Anchors are counted over the corpus
   by hash only (``announce``, ``shared_anchors``); one that occurs in a single
   document can't be in a repeat.
2. For the anchors that several documents have, the segments' bytes are shipped
   (``offer``) to the anchor's bucket.  Equal segments that one task holds at a
   time (``HELD_BYTES``) are settled there and then: all but the smallest id
   are repeats, and only the smallest travels.  An anchor with more than
   ``HOT_WINDOWS`` windows (a common line among different texts) has no bucket
   of its own: its segments are taken apart, and each window goes to the bucket
   of its hash, where equal windows meet.  Equal windows of a portion are
   settled as equal segments are, so any window, in any share of all documents,
   reaches its bucket once per portion.
3. In a bucket (``settle``), equal segments of different documents are settled
   likewise; the suffixes of what is left are sorted by hash-compared mergesort
   (see ``suffixes``), neighbours whose common extension reaches ``window``
   bytes form groups, confirmed byte by byte, and every window that a smaller
   id has too is a repeat.  Windows of hot anchors are grouped by their bytes.
4. Repeats go back to their documents as spans, and the bytes are cut out.

All steps take bounded memory: long documents are worked through in overlapping
pieces, and the number of buckets grows with the text.  Cutting holds a
document's bytes twice.  Entries that need no bucket in particular (settled
spans, anchors known to be shared) are dealt out from a place that depends on
the task, so that no bucket gets what every task begins with.

Defined results: a null text is empty; a document without id comes after all
others and doesn't repeat one without id; rows with the same id don't repeat
each other; texts shorter than ``window`` lose nothing; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.scratch import written
from kestrel.llm.suffixes import PrefixHashes, equal_groups, same_bytes, segments, sliding_minimum, sort_suffixes
from kestrel.llm.text import chunks, mix

WINDOW, GRAM = 50, 20
#: text that one bucket stands for, in the two shuffles
ANCHOR_BUCKET_BYTES = 64 << 20
SEGMENT_BUCKET_BYTES = 4 << 20
#: text worked on at a time, segments held back before they are shipped, and
#: windows sorted at a time (an anchor has fewer)
CHUNK_BYTES, HELD_BYTES, SORTED_WINDOWS = 1 << 20, 6 << 20, 1 << 18
#: an anchor with more windows is hot; at most ``HOT_LISTED`` of them, those
#: with the most windows, are listed on the driver and broadcast (8 bytes each);
#: further ones, each less than the text's size over ``HOT_LISTED``, keep a bucket
HOT_WINDOWS, HOT_LISTED = 1 << 16, 1 << 22
_LAST = np.iinfo(np.int64).max        # stands for a missing id
_MANY = np.iinfo(np.int64).min        # an anchor that several documents of a chunk have


def _pack(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    sizes = [n * np.dtype(k).itemsize for k in kinds]
    raw = pa.decompress(data, decompressed_size=sum(sizes), codec="zstd", asbytes=True) if n else b""
    at = np.cumsum([0, *sizes])
    return [np.frombuffer(raw[a:b], k) for a, b, k in zip(at, at[1:], kinds)]


def _pieces(batch: pa.RecordBatch, window: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """(rows, bytes, offsets, first byte): a text longer than a chunk comes in
    pieces that overlap by ``window - 1`` bytes."""
    for part, buf, off in chunks(batch, max_bytes=CHUNK_BYTES):
        if part.num_rows > 1 or len(buf) <= CHUNK_BYTES + window:
            yield part, buf, off, 0
            continue
        for lo in range(0, len(buf) - window + 1, CHUNK_BYTES):
            piece = buf[lo:lo + CHUNK_BYTES + window - 1]
            yield part, piece, np.array([0, len(piece)]), lo


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Places where a new combination of sorted keys begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _sizes(heads: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.concatenate((heads, [n])))


def _first_turn() -> int:
    """Where a task begins to deal out its entries: spread over all buckets."""
    from pyspark import TaskContext
    context = TaskContext.get()
    return int(mix(np.array([context.partitionId() + 1 if context else 1], np.uint64))[0] >> np.uint64(1))


def _keys(anchor: np.ndarray) -> np.ndarray:
    """48 bits of an anchor; a chance agreement only costs work later."""
    return (anchor >> np.uint64(16)).astype(np.int64)


_ANNOUNCED = "bucket int, known boolean, n int, keys binary, rows binary, windows binary"


def _announce(window: int, n_buckets: int):
    """rid, text -> per chunk and bucket the anchors with the row that has them
    (``_MANY`` for several, whose rows follow as ``known`` to share) and the
    number of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = _first_turn()
        for batch in batches:
            for part, buf, off, _ in _pieces(batch, window):
                anchor, _, n_win, doc = segments(buf, off, window, GRAM, PrefixHashes(buf))
                key, row = _keys(anchor), part.column(0).to_numpy()[doc]
                order = np.lexsort((row, key))
                key, row, n_win = key[order], row[order], n_win[order]
                head = _heads(key)
                if not len(head):
                    continue
                size = _sizes(head, len(key))
                many = row[head] != row[head + size - 1]
                of_many = np.repeat(many, size)
                out = [(turn % n_buckets, True, key[of_many], row[of_many], None)] if of_many.any() else []
                turn += 1
                n_win = np.add.reduceat(n_win, head).astype("<i4")       # at most a chunk's bytes
                key, row = key[head], np.where(many, _MANY, row[head])
                bucket = key % n_buckets
                order = np.lexsort((row, bucket))
                key, row, n_win, bucket = key[order], row[order], n_win[order], bucket[order]
                at = _heads(bucket)
                for a, b in zip(at, at + _sizes(at, len(bucket))):
                    out.append((int(bucket[a]), False, key[a:b], row[a:b], _pack(n_win[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out]),
                     pa.array([len(o[2]) for o in out], pa.int32()),
                     pa.array([_pack(o[2].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]) for o in out], pa.binary()),
                     pa.array([_pack(np.diff(o[3], prepend=o[3].dtype.type(0))) for o in out], pa.binary()),
                     pa.array([o[4] for o in out], pa.binary())],
                    names=["bucket", "known", "n", "keys", "rows", "windows"])
    return run


def _announced(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n, k, r in zip(*(table.column(c).to_pylist() for c in ("n", "keys", "rows"))):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = _unpack(k, 6 * n, "u1")[0].reshape(n, 6)
        keys.append(wide.view("<i8").ravel())
        with np.errstate(over="ignore"):
            rows.append(np.cumsum(_unpack(r, n, "<i8")[0]))
    return np.concatenate(keys), np.concatenate(rows)


def _shared(hot_windows: int):
    """(rid, key) for the anchors of a bucket that more than one entry has, and
    for those known to be shared; hot anchors also come without rid, with the
    number of their windows."""
    def run(table: pa.Table) -> pa.Table:
        known = table.column("known")
        first = table.filter(pc.invert(known))
        key, row = _announced(first)
        n_win = np.concatenate([np.zeros(0, np.int64), *(
            _unpack(w, n, "<i4")[0] for n, w in zip(*(first.column(c).to_pylist() for c in ("n", "windows"))))])
        order = np.argsort(key)
        key, row, n_win = key[order], row[order], n_win[order].astype(np.int64)
        head = _heads(key)
        size = _sizes(head, len(key))
        several = np.repeat(size > 1, size)
        take = several & (row != _MANY)
        of_key = np.add.reduceat(n_win, head) if len(head) else n_win
        hot, of_hot = key[head][of_key > hot_windows], of_key[of_key > hot_windows]
        more_key, more_row = _announced(table.filter(known))
        rid = np.concatenate((row[take], more_row, np.zeros(len(hot), np.int64)))
        none = np.arange(len(rid)) >= len(rid) - len(hot)
        windows = np.concatenate((np.zeros(len(rid) - len(hot), np.int64), of_hot))
        return pa.table({"rid": pa.array(rid, mask=none), "key": np.concatenate((key[take], more_key, hot)),
                         "windows": pa.array(windows, mask=~none)})
    return run


def announced(base: DataFrame, window: int, n_buckets: int) -> DataFrame:
    return base.select("rid", "text").mapInArrow(_announce(window, n_buckets), _ANNOUNCED)


def shared_anchors(base: DataFrame, window: int, n_buckets: int, hot_windows: int = HOT_WINDOWS,
                   hot_listed: int = HOT_LISTED) -> tuple[DataFrame, np.ndarray]:
    """((rid, keys), hot): the anchors of each row that other rows have too, and
    the hot ones, sorted."""
    found = written(announced(base, window, n_buckets).groupBy("bucket")
                    .applyInArrow(_shared(hot_windows), "rid long, key long, windows long"), "shared-anchors")
    hot = found.where("rid is null")
    if hot.count() > hot_listed:
        hot = hot.orderBy(F.desc("windows"), "key").limit(hot_listed)
    listed = hot.select("key").toArrow().column("key")
    return (found.where("rid is not null").groupBy("rid").agg(F.collect_list("key").alias("keys")),
            np.unique(listed.to_numpy()))


_OFFERED = "bucket int, n int, size long, meta binary, body binary, hot boolean"
_META = ("<i4", "<i8", "<i8", "<i8")             # length, rid, id, start
_SPAN = ("<i8", "<i8", "<i8", "<i8")              # rid, id, start, end


def _ids(part: pa.RecordBatch) -> np.ndarray:
    return part.column(part.schema.get_field_index("doc_id")).fill_null(_LAST).to_numpy()


def _gather(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    first = np.cumsum(length) - length
    return buf[np.repeat(start - first, length) + np.arange(int(length.sum()))]


def _merged(rid: np.ndarray, ident: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Spans of the same row that touch become one."""
    order = np.lexsort((start, ident, rid))
    rid, ident, start, end = rid[order], ident[order], start[order], end[order]
    if not len(rid):
        return [rid, ident, start, end]
    head = np.zeros(len(rid), bool)
    head[_heads(rid, ident)] = True
    row = np.cumsum(head)
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + row * span) - row * span     # furthest end so far in the row
    new = head.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = at + _sizes(at, len(rid)) - 1
    return [rid[at], ident[at], start[at], reach[last]]


def _hot_windows(buf: np.ndarray, start: np.ndarray, length: np.ndarray, rid: np.ndarray, ident: np.ndarray,
                 at: np.ndarray, window: int) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray], np.ndarray]:
    """Segments taken apart: (settled, hash, spans, bytes).  Of equal windows
    the places of larger ids are settled; the others' places in a row, joined
    where they touch, are the spans of one window."""
    body = _gather(buf, start, length)
    hashes = PrefixHashes(body)
    n_win = length - window + 1
    each = np.repeat(np.arange(len(n_win)), n_win)
    skip = np.arange(len(each)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    pos = np.repeat(np.cumsum(length) - length, n_win) + skip
    whole = hashes.of(pos, window)
    order = np.lexsort((rid[each], ident[each], whole))
    each, skip, pos, whole = each[order], skip[order], pos[order], whole[order]
    row, who, begin = rid[each], ident[each], at[each] + skip
    head = _heads(whole)
    lead = np.repeat(head, _sizes(head, len(whole)))
    same = same_bytes(body, pos, pos[lead], np.full(len(pos), window))
    later = same & (who > who[lead])
    settled = _merged(row[later], who[later], begin[later], begin[later] + window)
    stay = np.flatnonzero(~later)
    alone = np.where(same[stay], 0, stay)                   # a hash collision stands alone
    order = np.lexsort((begin[stay], alone, row[stay], who[stay], whole[stay]))
    stay, alone = stay[order], alone[order]
    head = _heads(whole[stay], who[stay], row[stay], alone)
    group = np.repeat(np.arange(len(head)), _sizes(head, len(stay)))
    group, ids, begin, end = _merged(group, who[stay], begin[stay], begin[stay] + window)
    one = stay[head[group]]
    return settled, whole[one], [row[one], ids, begin, end], body[pos[one][:, None] + np.arange(window)]


def _offer(window: int, n_buckets: int, hot):
    """doc_id, rid, text, keys -> per portion and bucket the segments of shared
    anchors and the windows of ``hot`` ones; a row without ``size`` holds spans
    that are settled already."""
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())

    def portion(held: list[tuple], turn: int) -> pa.RecordBatch:
        buf, key, whole, length, rid, ident, at = (np.concatenate(x) for x in zip(*held))
        start = np.cumsum(length) - length
        order = np.lexsort((ident, length, whole))
        head = _heads(whole[order], length[order])
        lead = np.empty(len(order), np.int64)
        lead[order] = np.repeat(order[head], _sizes(head, len(order)))
        later = np.flatnonzero(ident > ident[lead])
        later = later[same_bytes(buf, start[later], start[lead[later]], length[later])]
        out = []

        def settle(spans: list[np.ndarray]) -> None:
            if len(spans[0]):
                out.append((turn % n_buckets, len(spans[0]), None, _pack(*[s.astype("<i8") for s in spans]), None, False))

        settle(_merged(rid[later], ident[later], at[later], (at + length)[later]))
        stay = np.ones(len(key), bool)
        stay[later] = False
        apart = np.isin(key, hot.value) & stay
        apart, stay = np.flatnonzero(apart), np.flatnonzero(stay & ~apart)
        bucket = key % n_buckets
        stay = stay[np.argsort(bucket[stay], kind="stable")]
        edge = _heads(bucket[stay])
        for a, b in zip(edge, edge + _sizes(edge, len(stay))):
            some = stay[a:b]
            body = _gather(buf, start[some], length[some])
            out.append((int(bucket[some[0]]), len(some), len(body),
                        _pack(length[some].astype("<i4"), rid[some], ident[some], at[some]), _pack(body), False))
        apart = apart[np.argsort(key[apart], kind="stable")]     # equal windows mostly come in the same turn
        edge = _heads((np.cumsum(length[apart] - window + 1) - 1) // SORTED_WINDOWS)
        for a, b in zip(edge, edge + _sizes(edge, len(apart))):
            some = apart[a:b]
            spans, hashed, places, body = _hot_windows(buf, *(x[some] for x in (start, length, rid, ident, at)), window)
            settle(spans)
            to = (mix(hashed) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            first = _heads(to[order])
            for c, d in zip(first, first + _sizes(first, len(to))):
                mine = order[c:d]
                out.append((int(to[mine[0]]), len(mine), len(mine) * window,
                            _pack(*[p[mine].astype("<i8") for p in places]), _pack(body[mine]), True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                          names=["bucket", "n", "size", "meta", "body", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, _first_turn()
        for batch in batches:
            for part, buf, off, base in _pieces(batch, window):
                hashes = PrefixHashes(buf)
                anchor, start, windows, doc = segments(buf, off, window, GRAM, hashes)
                take = np.flatnonzero(np.isin(_keys(anchor), np.unique(part.column(3).flatten().to_numpy())))
                if not len(take):
                    continue
                start, doc, length = start[take], doc[take], windows[take] + window - 1
                held.append((_gather(buf, start, length), _keys(anchor[take]), hashes.of(start, length),
                             length, part.column(1).to_numpy()[doc], _ids(part)[doc], start - off[doc] + base))
                size += len(held[-1][0])
                if size >= HELD_BYTES:
                    yield portion(held, turn)
                    held, size, turn = [], 0, turn + 1
        if held:
            yield portion(held, turn)
    return run


def _settle(window: int):
    """A bucket's segments and windows -> spans (rid, id, start, end) that repeat."""
    def run(table: pa.Table) -> pa.Table:
        done: list[list[np.ndarray]] = []
        metas, bodies, places, windows = [], [], [], []
        for n, size, meta, body, hot in zip(*(table.column(c).to_pylist() for c in ("n", "size", "meta", "body", "hot"))):
            if size is None:
                done.append(_unpack(meta, n, *_SPAN))
            elif hot:
                places.append(_unpack(meta, n, *_SPAN))
                windows.append(_unpack(body, size, "u1")[0])
            else:
                metas.append(_unpack(meta, n, *_META))
                bodies.append(_unpack(body, size, "u1")[0])
        if metas:
            done += _repeats(np.concatenate(bodies), *(np.concatenate(m) for m in zip(*metas)), window)
        if places:
            spans = [np.concatenate(p) for p in zip(*places)]
            of = np.unique(np.concatenate(windows).view(f"V{window}"), return_inverse=True)[1]
            smallest = np.full(int(of.max()) + 1, _LAST)
            np.minimum.at(smallest, of, spans[1])
            done.append([s[spans[1] > smallest[of]] for s in spans])
        spans = [np.concatenate(s) for s in zip(*done)] if done else [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(("rid", "id", "start", "end"), _merged(*spans))))
    return run


def _repeats(buf: np.ndarray, length: np.ndarray, rid: np.ndarray, ident: np.ndarray,
             at: np.ndarray, window: int) -> list[list[np.ndarray]]:
    length = length.astype(np.int64)
    start = np.cumsum(length) - length
    hashes = PrefixHashes(buf)
    anchor = sliding_minimum(mix(hashes.sliding(GRAM)), window - GRAM + 1)[start]
    whole = hashes.of(start, length)
    order = np.lexsort((ident, length, whole, anchor))
    anchor, length, rid, ident, at, start, whole = (x[order] for x in (anchor, length, rid, ident, at, start, whole))
    # equal segments: the smallest id leads, larger ids repeat it
    head = _heads(anchor, whole, length)
    lead = np.repeat(head, _sizes(head, len(anchor)))
    same = same_bytes(buf, start, start[lead], length)
    lead = np.where(same, lead, np.arange(len(lead)))       # a hash collision stands alone
    later = ident > ident[lead]
    out = [[rid[later], ident[later], at[later], (at + length)[later]]]
    # one segment per class against the other classes of its anchor
    cls = np.flatnonzero(lead == np.arange(len(lead)))
    group = _heads(anchor[cls])
    in_group = _sizes(group, len(cls))
    cls = cls[np.repeat(in_group > 1, in_group)]
    group = _heads(anchor[cls])
    n_win = length[cls] - window + 1
    weight = np.add.reduceat(n_win, group) if len(group) else n_win
    batch = np.cumsum(weight) // SORTED_WINDOWS
    edge = np.append(group[_heads(batch)], len(cls))
    found = [_class_repeats(hashes, start, ident, anchor, cls[a:b], n_win[a:b], window) for a, b in zip(edge, edge[1:])]
    found = [f for f in found if len(f[0])]
    if not found:
        return out
    c, lo, hi = (np.concatenate(x) for x in zip(*found))
    # a class's spans in each place of its smallest id
    place = np.flatnonzero(ident == ident[lead])
    place = place[np.argsort(lead[place], kind="stable")]
    begin, stop = np.searchsorted(lead[place], c, "left"), np.searchsorted(lead[place], c, "right")
    k = stop - begin
    each = np.repeat(np.arange(len(c)), k)
    who = place[np.repeat(begin - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
    out.append([rid[who], ident[who], at[who] + lo[each], at[who] + hi[each]])
    return out


def _class_repeats(hashes: PrefixHashes, start: np.ndarray, ident: np.ndarray, anchor: np.ndarray,
                   cls: np.ndarray, n_win: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, from, to): the spans of each class's segment whose windows a
    smaller id has too, in a segment of the same anchor."""
    first = np.cumsum(n_win) - n_win
    total = int(n_win.sum())
    owner = np.repeat(np.arange(len(cls), dtype=np.int32), n_win)
    suffix = (np.repeat(start[cls] - first, n_win) + np.arange(total)).astype(np.int32)
    # a window that comes again in its own segment (a text like "ha ha ha") is sorted once
    whole = hashes.of(suffix, window)
    key = mix(whole ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    once, of_once = np.unique(key, return_index=True, return_inverse=True)[1:]
    again = np.flatnonzero(once[of_once] != np.arange(total))
    as_one = once[of_once[again]]
    alike = (owner[again] == owner[as_one]).all() and same_bytes(
        hashes.buf, suffix[again].astype(np.int64), suffix[as_one].astype(np.int64), np.full(len(again), window)).all()
    if not alike:                 # a collision: sort every window
        once, of_once = np.arange(total), np.arange(total)
    label = np.zeros(len(cls), np.int64)
    label[_heads(anchor[cls])] = 1
    label = np.cumsum(label)[owner[once]]
    by_label = np.argsort(label, kind="stable")
    suffixes, label, smallest_id = suffix[once][by_label].astype(np.int64), label[by_label], ident[cls][owner[once]][by_label]
    order = sort_suffixes(hashes, suffixes, label, window)
    run = equal_groups(hashes, suffixes, label, order, window)
    smallest = np.minimum.reduceat(smallest_id[order], _heads(run))
    repeat = np.zeros(len(once), bool)
    repeat[by_label[order]] = smallest_id[order] > smallest[run]
    hit = np.flatnonzero(repeat[of_once])
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit][1:] != owner[hit][:-1])
    a = np.flatnonzero(new)
    b = a + _sizes(a, len(hit)) - 1
    c = owner[hit[a]]
    return cls[c], hit[a] - first[c], hit[b] - first[c] + window


_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _cut():
    """doc_id, rid, text, spans -> the texts without their spans."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch, max_bytes=CHUNK_BYTES):
                ident = _ids(part)
                col = part.column(3)
                edge = np.concatenate(([0], np.cumsum(np.nan_to_num(
                    np.array(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))).astype(np.int64))))
                flat = col.flatten()
                owner, start, end = (flat.field(i).to_numpy() for i in range(3))
                removed, spans, kept = [], [], []
                for i in range(part.num_rows):
                    text = buf[off[i]:off[i + 1]]
                    mine = slice(edge[i], edge[i + 1])
                    own = owner[mine] == ident[i]
                    none = np.zeros(int(own.sum()), np.int64)
                    _, _, a, b = _merged(none, none, start[mine][own], end[mine][own])
                    removed.append(int((b - a).sum()))
                    spans.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())])
                    gaps = zip([0, *b.tolist()], [*a.tolist(), len(text)])
                    kept.append(b"".join(text[x:y].tobytes() for x, y in gaps if y > x))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(spans, kind),
                     pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
    return run


def offered(base: DataFrame, window: int = WINDOW, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """The buckets of ``base`` (doc_id, rid, text): its packed segments and
    windows of anchors that several rows have."""
    n_bytes = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    anchors, hot = shared_anchors(base, window, max(least, n_bytes // ANCHOR_BUCKET_BYTES), hot_windows)
    hot = base.sparkSession.sparkContext.broadcast(hot)
    n_buckets = max(least, n_bytes // SEGMENT_BUCKET_BYTES)
    return (base.join(anchors, "rid").select("doc_id", "rid", "text", "keys")
            .mapInArrow(_offer(window, n_buckets, hot), _OFFERED))


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) per row of ``docs`` (doc_id,
    text): bytes of the text, bytes removed, the maximal removed spans, and the
    remaining bytes."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").alias("rid"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # base is shuffled by rid once: both joins read the same exchange
    spans = (offered(base, window, hot_windows)
             .groupBy("bucket").applyInArrow(_settle(window), "rid long, id long, start long, end long")
             .groupBy("rid").agg(F.collect_list(F.struct("id", "start", "end")).alias("spans")))
    return (base.join(spans, "rid", "left").select("doc_id", "rid", "text", "spans")
            .mapInArrow(_cut(), _RESULT))
