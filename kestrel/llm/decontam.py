"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is short and a document may be long, so their Jaccard similarity
is tiny even when the item is wholly contained.  Documents are therefore
partitioned by the size of their shingle set (powers of two), and the number
of one-permutation bins grows with the class: ``BINS_PER_SHINGLE`` bins for
each shingle of the class's largest set.  A shingle that item and document
share then stays the minimum of its bin in both with a chance of at least 0.79,
whatever the document's length, and an item of q shingles of which 0.8 q are in
the document is missed with a chance of at most 0.21 ** (0.8 q).  Items below
``SMALL_ITEM`` shingles, for which that is not negligible, are looked up by all
their shingles.

A document becomes a candidate of an item when any bin agrees.  Candidates are
verified by exact containment of the item's shingle set in the document's.

An item of fewer words than a shingle is one shingle of just its words: it is
contained in every document that has these words in a row, wherever they stand,
and is looked up among the document's shingles of that many words.

Items travel to the documents in blocks of bounded size (one pass over the
documents per block, and one index per task); documents are never shuffled.

Defined results: null or blank texts contain nothing and are contained in
nothing; rows that repeat an item id report their highest containment; empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kestrel.llm.scratch import written
from kestrel.llm.text import chunks, per_document, shingles, utf8_bytes, words

BINS_PER_SHINGLE = 2
SMALL_ITEM = 16
#: item text that one pass carries to the documents
BLOCK_BYTES = 16 << 20
_GATE = 1 << 22


def size_class(n: int) -> int:
    """Class c holds sets of 2**(c - 1) < n <= 2**c shingles."""
    return max(0, int(n - 1).bit_length())


def bin_minima(hashes: np.ndarray, of_class: int) -> np.ndarray:
    """One-permutation sketch of sorted distinct hashes for a size class: the
    smallest hash of every bin that is not empty."""
    bits = min(63, of_class + (BINS_PER_SHINGLE - 1).bit_length())
    bin_of = hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64)
    return hashes[np.concatenate(([True], bin_of[1:] != bin_of[:-1]))]


class ItemIndex:
    """A block of items: their shingle sets, and per size class the sketch
    hashes with the items that have them."""

    def __init__(self, ids: list, texts: pa.Array, width: int):
        word, doc, _ = words(*utf8_bytes(texts))
        hashes, owner = shingles(word, doc, width)
        lengths = np.bincount(doc, minlength=len(ids))
        self.ids, self.sets, below = [], [], []
        for i, h, n in zip(ids, per_document(hashes, owner, len(ids)), lengths.tolist()):
            if len(h):
                self.ids.append(i)
                self.sets.append(np.unique(h))
                below.append(n if n < width else 0)
        # items shorter than a shingle, by their number of words: (hashes, items)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in sorted(set(below) - {0}):
            item = np.array([i for i, n in enumerate(below) if n == k], np.int64)
            hashed = np.array([self.sets[i][0] for i in item], np.uint64)
            order = np.argsort(hashed, kind="stable")
            self.short[k] = hashed[order], item[order]
        self.long = [i for i, n in enumerate(below) if not n]
        self.gate = np.zeros(_GATE, bool)
        for i in self.long:
            self.gate[self.sets[i] & np.uint64(_GATE - 1)] = True
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of_class(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        if c not in self.classes:
            sketch = [s if len(s) < SMALL_ITEM else bin_minima(s, c) for s in (self.sets[i] for i in self.long)]
            hashes = np.concatenate(sketch) if sketch else np.zeros(0, np.uint64)
            item = np.repeat(np.array(self.long, np.int64), [len(s) for s in sketch])
            order = np.argsort(hashes, kind="stable")
            self.classes[c] = hashes[order], item[order]
        return self.classes[c]

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Items with a bin that agrees with a document's distinct ``hashes``."""
        c = size_class(len(hashes))
        known, item = self.of_class(c)
        sketch = bin_minima(hashes, c)
        seen = [sketch[self.gate[sketch & np.uint64(_GATE - 1)]]]
        if self.has_small:
            rest = hashes[self.small_gate[hashes & np.uint64(_GATE - 1)]]
            seen.append(rest)
        probe = np.unique(np.concatenate(seen))
        lo, hi = np.searchsorted(known, probe, "left"), np.searchsorted(known, probe, "right")
        return np.unique(np.concatenate([item[a:b] for a, b in zip(lo, hi) if b > a] or [item[:0]]))

    @property
    def has_small(self) -> bool:
        return bool(self.small_gate.any())

    @property
    def small_gate(self) -> np.ndarray:
        if not hasattr(self, "_small_gate"):
            self._small_gate = np.zeros(_GATE, bool)
            for s in (self.sets[i] for i in self.long):
                if len(s) < SMALL_ITEM:
                    self._small_gate[s & np.uint64(_GATE - 1)] = True
        return self._small_gate

    def short_items(self, word: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
        """(document, item) for the short items whose words stand in a row there."""
        out = set()
        for k, (known, item) in self.short.items():
            hashes, owner = shingles(word, doc, k)
            lo, hi = np.searchsorted(known, hashes, "left"), np.searchsorted(known, hashes, "right")
            for at in np.flatnonzero(hi > lo):
                out.update((int(owner[at]), int(i)) for i in item[lo[at]:hi[at]])
        return sorted(out)


def _matches(index: ItemIndex, part: pa.RecordBatch, buf: np.ndarray, off: np.ndarray, width: int,
             least: float) -> list[tuple[int, int, int]]:
    """(row, item, shared shingles) for items contained in a row's text."""
    word, doc, _ = words(buf, off)
    hashes, owner = shingles(word, doc, width)
    out = [(row, item, 1) for row, item in index.short_items(word, doc)]
    for row, h in enumerate(per_document(hashes, owner, part.num_rows)):
        if len(h) and index.long:
            h = np.unique(h)
            for item in index.candidates(h):
                wanted = index.sets[item]
                at = np.minimum(np.searchsorted(h, wanted), len(h) - 1)
                shared = int((h[at] == wanted).sum())
                if shared >= least * len(wanted) - 1e-9:
                    out.append((row, int(item), shared))
    return out


def _blocks(items: DataFrame, width: int, block_bytes: int) -> Iterator[ItemIndex]:
    # rows that agree in both columns would share a block
    items = written(items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // block_bytes)
    for k in range(n):   # a block is bounded by block_bytes, up to the hash's unevenness
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield ItemIndex([r[0] for r in rows], pa.array([r[1] for r in rows], pa.string()), width)


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, least: float = 0.8,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment): the pairs in which
    a document (doc_id, text) holds at least ``least`` of an item's (item_id,
    text) distinct ``width``-word shingles."""
    spark = docs.sparkSession
    doc_type, item_type = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    ids_type = to_arrow_type(item_type)
    schema = (f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, "
              "n_shingles long, n_shared long")
    found = spark.createDataFrame([], schema)
    for block in _blocks(items, width, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part, buf, off in chunks(batch):
                    hits = _matches(index, part, buf, off, width, least)
                    rows, which, n = zip(*hits) if hits else ((), (), ())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows, pa.int64())),
                         pa.array([index.ids[i] for i in which], ids_type),
                         pa.array([len(index.sets[i]) for i in which], pa.int64()), pa.array(n, pa.int64())],
                        names=["doc_id", "item_id", "n_shingles", "n_shared"])

        found = found.union(docs.select("doc_id", "text").mapInArrow(run, schema))
    best = F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shingles", "n_shared"))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("m"))
            .select("doc_id", "item_id", "m.n_shingles", "m.n_shared", "m.containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 5, least: float = 0.8,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that contain an item; no shuffle.  What a block
    of items leaves is written before the next one comes, so a task holds one
    block's index however many there are."""
    spark = docs.sparkSession
    for k, block in enumerate(_blocks(items, width, block_bytes)):
        docs = written(docs, "decontaminated") if k else docs
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, buf, off in chunks(batch):
                    keep = np.ones(part.num_rows, bool)
                    keep[[r for r, _, _ in _matches(shared.value, part, buf, off, width, least)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
