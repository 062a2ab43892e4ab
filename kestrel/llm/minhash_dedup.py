"""MinHash near-duplicates: one-permutation hashing, banded buckets, star edges.

1. Every document's distinct word shingles are hashed once; the top bits choose
   one of ``bins`` bins and each bin keeps its smallest hash.  Empty bins copy
   from a bin chosen by a hash of (bin, attempt), the same for all documents
   (optimal densification).  ``rows`` bins make a band; equal bands share a
   bucket.
2. Documents with the same shingle set form one class and are represented by
   the smallest id, so exact copies never meet in pairs.
3. In every bucket the class that shares most buckets with others is the
   centre; only (centre, member) pairs become candidates, so a bucket of m
   classes gives m - 1 pairs.  The pairs' full shingle sets are compared.
   Members of large buckets meet their centre by a broadcast of the few such
   centres, so no bucket is gathered in one task.
4. Buckets whose members fell into one component are done, and so are those of
   two members, whose one pair was compared.  In the others the shingle sets of
   different components are intersected in bounded blocks (a
   matrix product per block pair), and only pairs that reach the similarity
   leave the block.  No pair of one bucket is given up for its bucket's size,
   and none is emitted unseen.

Links are exact (``confirm`` compares the shingles themselves); two documents
that should be linked are missed only if no band agrees, at similarity 0.8 with
32 bands of 4 rows with a chance of about 5e-8.

Defined results: a null or blank text has no shingles and is linked with
nothing; a text of fewer words than a shingle gives its whole sequence as one;
rows without id are linked with nothing; rows that share an id are one document
with all their links; other columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.graph import components, hub_join, shared_id_links
from kestrel.llm.scratch import written
from kestrel.llm.text import chunks, mix, per_document, shingles, words

BLOCK_ROWS = 512
#: so many ids and text hashes (16 bytes each), or pairs of them, may be broadcast
BROADCAST_IDS = 200_000
_K1, _K2 = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def one_permutation(hashes: np.ndarray, doc: np.ndarray, n_docs: int, bins: int) -> np.ndarray:
    """Densified one-permutation MinHash, a row per document: ``hashes`` are
    distinct and sorted in each document; ``bins`` is a power of two.  Rows of
    documents without hashes are zero."""
    shift = np.uint64(64 - (bins.bit_length() - 1))
    sig, full = np.zeros(n_docs * bins, np.uint64), np.zeros(n_docs * bins, bool)
    if not len(hashes):
        return sig.reshape(n_docs, bins)
    place = doc * bins + (hashes >> shift).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    sig[place[first]], full[place[first]] = hashes[first], True
    any_full = full.reshape(n_docs, bins).any(axis=1)
    empty = np.flatnonzero(~full & np.repeat(any_full, bins))
    attempt = 0
    while len(empty):
        attempt += 1
        salt = np.uint64(attempt * int(_K2) % 2**64)
        donor = (mix(np.arange(1, bins + 1, dtype=np.uint64) * _K1 + salt) >> shift).astype(np.int64)
        source = empty // bins * bins + donor[empty % bins]
        ok = full[source]
        sig[empty[ok]] = sig[source[ok]]
        empty = empty[~ok]
    return sig.reshape(n_docs, bins)


def signatures(docs: DataFrame, width: int, bins: int, rows: int) -> DataFrame:
    """(doc_id, tie, n, s1, s2, bands) per row: number of distinct shingles, a
    128-bit hash of the set, and the band hashes."""
    n_bands = bins // rows
    salt = mix(np.arange(1, n_bands + 1, dtype=np.uint64) * _K2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch, max_rows=4096):
                word, doc, _ = words(buf, off)
                hashes, owner = shingles(word, doc, width)
                sets = [np.unique(h) for h in per_document(hashes, owner, part.num_rows)]
                n = np.array([len(h) for h in sets], np.int64)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                owner = np.repeat(np.arange(len(n)), n)
                sums = []
                for key in (_K1, _K2):
                    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat ^ key), dtype=np.uint64)))
                    end = np.cumsum(n)
                    sums.append((upto[end] - upto[end - n]).view(np.int64))
                sig = one_permutation(flat, owner, len(n), bins)
                band = np.broadcast_to(salt, (len(n), n_bands))
                for k in range(rows):
                    band = mix(band ^ sig[:, k:n_bands * rows:rows])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), *map(pa.array, sums),
                     pa.array(list(band.view(np.int64)), pa.list_(pa.int64()))],
                    names=["doc_id", "tie", "n", "s1", "s2", "bands"])

    slim = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")
    return slim.mapInArrow(run, "doc_id long, tie long, n long, s1 long, s2 long, bands array<long>")


def _texts(docs: DataFrame, ids: DataFrame, at_most: int) -> DataFrame:
    """(id, t, text) of the rows named by ``ids`` (id, t: id and text hash;
    ``at_most`` rows).  Up to ``BROADCAST_IDS`` of them are broadcast, so that
    other texts don't move; beyond that the tables are joined by a shuffle."""
    text = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    ids = ids.select("id", "t").distinct()
    if at_most > BROADCAST_IDS:
        ids = written(ids, "ids")
        at_most = ids.count()
    return text.join(F.broadcast(ids) if at_most <= BROADCAST_IDS else ids, ["id", "t"], "left_semi")


def _hash_sets(texts: DataFrame, width: int) -> DataFrame:
    """(id, t, hashes): 32 bits of each distinct shingle's hash, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch):
                word, doc, _ = words(buf, off)
                hashes, owner = shingles(word, doc, width)
                packed = [np.unique((h >> np.uint64(32)).astype(np.uint32)).tobytes()
                          for h in per_document(hashes, owner, part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())],
                                                 names=["id", "t", "hashes"])
    return texts.mapInArrow(run, "id long, t long, hashes binary")


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections, as products of incidence matrices over
    ``columns`` shared elements at a time."""
    out = np.zeros((len(sets), len(sets)), np.float32)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    element = np.cumsum(new) - 1
    shared = np.bincount(element)[element] > 1
    if not shared.any():
        return out
    row, element = row[shared], element[shared]
    element = np.cumsum(np.concatenate(([0], (element[1:] != element[:-1]).astype(np.int64))))
    for lo in range(0, int(element[-1]) + 1, columns):
        a, b = np.searchsorted(element, (lo, lo + columns))
        part = np.zeros((len(sets), min(columns, int(element[-1]) + 1 - lo)), np.float32)
        part[row[a:b], element[a:b] - lo] = 1
        out += part @ part.T
    return out


def _similar(percent: int):
    """Pairs of a block, of different components, that may reach ``percent``:
    ``n`` counts the shingles, and each one that the 32-bit hashes lost to a
    collision may be shared."""
    def run(table: pa.Table) -> pa.Table:
        one = lambda c: table.column(c).to_numpy()
        ident, tie, root, mine, x, y = map(one, ("id", "t", "root", "own", "x", "y"))
        sets = [np.frombuffer(s, np.uint32) for s in table.column("hashes").to_pylist()]
        a = b = np.zeros(0, np.int64)
        if len(np.unique(root)) > 1:
            n = one("n")
            lost = n - np.array([len(s) for s in sets], np.int64)
            both = overlaps(sets).astype(np.int64) + np.minimum(lost[:, None], lost[None, :])
            ok = 100 * both >= percent * (n[:, None] + n[None, :] - both)
            ok &= (root[:, None] != root[None, :]) & (mine == x)[:, None] & (mine == y)[None, :]
            a, b = np.nonzero(np.triu(ok, 1) if x[0] == y[0] else ok)
        return pa.table({"a": ident[a], "ta": tie[a], "b": ident[b], "tb": tie[b]})
    return run


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) of those candidate pairs (a, ta, b, tb: ids and text hashes)
    whose full shingle sets A, B have 100 |A & B| >= percent |A | B|."""
    def shingle_set(text: bytes) -> set:
        w = text.lower().split()
        return {tuple(w)} if len(w) < width else set(zip(*[w[k:] for k in range(width)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kept = None, set()
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i) for i in range(4))
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                right = text_b[i].as_buffer().to_pybytes()
                if right != seen:      # rows come sorted by b: one set for a centre's run
                    seen, kept = right, shingle_set(right)
                left = shingle_set(text_a[i].as_buffer().to_pybytes())
                both = len(left & kept)
                ok[i] = 100 * both >= percent * (len(left) + len(kept) - both)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok)), b.filter(pa.array(ok))], names=["a", "b"])

    pairs = written(pairs, "pairs")
    n = pairs.count()
    if not n:
        return pairs.select("a", "b")
    ends = pairs.select(F.col("a").alias("id"), F.col("ta").alias("t")).union(pairs.select("b", "tb"))
    text = _texts(docs, ends, 2 * n)
    if n <= BROADCAST_IDS:
        pairs = F.broadcast(pairs)
    left = text.toDF("a", "ta", "text_a")
    right = text.toDF("b", "tb", "text_b")
    return (pairs.join(left, ["a", "ta"]).join(right, ["b", "tb"])
            .select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))


def _close(x: str, y: str, percent: int):
    """Set sizes that allow the similarity."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _open_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their component, of buckets that hold several components
    and more members than the centre and one that was compared with it."""
    rooted = (members.join(roots.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("root", F.coalesce("root", "id")))
    rooted = written(rooted, "rooted")
    split = (rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                        F.count("*").alias("m")).where("lo <> hi and m > 2").select("band", "m"))
    return written(rooted.drop("m").join(written(split, "split"), "band"), "open")


def duplicate_classes(docs: DataFrame, width: int = 5, percent: int = 80, bins: int = 128, rows: int = 4,
                      block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(signatures, classes): the per-row signatures and, for each class of
    equal shingle sets (s1, s2, n), its ``component_id``."""
    sig = written(signatures(docs, width, bins, rows), "signatures")
    classes = written(sig.where("n > 0 and doc_id is not null").groupBy("s1", "s2", "n")
                      .agg(F.min(F.struct("doc_id", "tie", "bands")).alias("rep"))
                      .select("s1", "s2", "n", F.col("rep.doc_id").alias("id"), F.col("rep.tie").alias("t"),
                              "rep.bands"), "classes")
    entries = classes.select("id", "t", "n", F.explode("bands").alias("band"))
    shared = written(entries.groupBy("band").agg(F.count("*").alias("m")).where("m > 1"), "shared")
    # written as joined: AQE splits the partitions of large buckets, and entries that share no band need no pass for hubs
    members = written(entries.join(shared, "band"), "members")
    degree = members.groupBy("id", "t").agg(F.sum(F.col("m") - 1).alias("degree"))
    centre = (members.join(degree, ["id", "t"]).groupBy("band")
              .agg(F.max(F.struct("degree", (-F.col("id")).alias("low"), F.col("id").alias("b"),
                                  F.col("t").alias("tb"), F.col("n").alias("nb"))).alias("c"), F.count("*").alias("m"))
              .select("band", "c.b", "c.tb", "c.nb", "m"))
    star = (hub_join(members.drop("m"), written(centre, "centres"), "band", "m")
            .where(~((F.col("id") == F.col("b")) & (F.col("t") == F.col("tb"))) & _close("n", "nb", percent))
            .select(F.col("id").alias("a"), F.col("t").alias("ta"), "b", "tb").distinct())
    links = confirm(star, docs, width, percent)
    several = (sig.where("n > 0 and doc_id is not null").groupBy("doc_id")
               .agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).where("lo <> hi").select("doc_id"))
    if not several.isEmpty():      # an id with several texts: its classes belong together
        own = sig.join(several, "doc_id", "left_semi").join(classes, ["s1", "s2", "n"])
        links = links.union(shared_id_links(own.select(F.col("doc_id").alias("id"), F.col("id").alias("node"))))
    roots = written(components(links), "roots")
    open_ = _open_buckets(members, roots)
    blocks = F.ceil(F.col("m") / block_rows).cast("int")
    dealt = (open_.join(_hash_sets(_texts(docs, open_, open_.count()), width), ["id", "t"])
             .withColumn("own", F.pmod(F.xxhash64("id", "t"), blocks).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumns({"x": F.least("own", "o"), "y": F.greatest("own", "o")}))
    rest = (dealt.groupBy("band", "x", "y").applyInArrow(_similar(percent), "a long, ta long, b long, tb long")
            .select(*[F.when(F.col("a") < F.col("b"), F.col(p)).otherwise(F.col(q)).alias(p)
                      for p, q in (("a", "b"), ("ta", "tb"), ("b", "a"), ("tb", "ta"))]).distinct())
    more = written(confirm(rest, docs, width, percent).distinct(), "more-links")
    out = (classes.select("s1", "s2", "n", "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
           .select("s1", "s2", "n", F.coalesce("root", "id").alias("component_id")))
    if not more.isEmpty():      # they join whole components: only roots are contracted again
        across = (more.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
                  .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
        upper = written(components(across), "upper-roots")
        out = (out.join(upper.withColumnRenamed("node", "component_id"), "component_id", "left")
               .select("s1", "s2", "n", F.coalesce("root", "component_id").alias("component_id")))
    return sig, written(out, "class-components")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, **options) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, kept) per row of ``docs``
    (doc_id, text, ...); ``tie`` is the xxhash64 of its text."""
    sig, classes = duplicate_classes(docs, width, percent, **options)
    return (sig.drop("bands").join(classes, ["s1", "s2", "n"], "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
            .select("doc_id", "tie", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, **options) -> DataFrame:
    """``docs`` with one document of each group, the one of smallest id; of
    rows that repeat an id, one row."""
    found = written(near_duplicates(docs, width, percent, **options), "found")
    kept = (found.where("kept").groupBy("doc_id").agg(F.min("tie").alias("__tie"), F.count("*").alias("__rows")))
    key = {"__id": F.col("doc_id").cast("long"), "__tie": F.xxhash64("text")}
    out = (docs.withColumns(key)
           .join(kept.withColumnRenamed("doc_id", "__id").select("__id", "__tie"), ["__id", "__tie"], "left_semi"))
    if not kept.where("__rows > 1 and doc_id is not null").isEmpty():
        out = out.dropDuplicates(["__id", "__tie"])
    return out.select(*docs.columns).union(docs.where("doc_id is null"))
