"""Vectorised text helpers for Arrow batches: words, word hashes, shingles.

A batch of texts is one uint8 buffer plus document offsets; words, their
64-bit hashes and shingle hashes are computed with numpy over the whole
buffer, so no Python loop runs per word.  ``chunks`` keeps a step's working
set bounded whatever the batch size; one very long text forms a chunk of its
own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(0x5EED)
#: a random odd 64-bit value per byte, equal for A-Z and a-z
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)
_STEP = np.uint64(0xD1342543DE82EF95)
_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(33))) * _C1
    h = (h ^ (h >> np.uint64(33))) * _C2
    return h ^ (h >> np.uint64(33))


def utf8_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, column: str = "text", max_bytes: int = CHUNK_BYTES,
           max_rows: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split a batch into slices of at most ``max_bytes`` of text (one longer
    text alone in its slice) and ``max_rows`` rows: (slice, bytes, offsets)."""
    if not batch.num_rows:
        return
    buf, off = utf8_bytes(batch.column(batch.schema.get_field_index(column)))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + max_rows, batch.num_rows)
        yield batch.slice(lo, hi - lo), buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: (64-bit hash of the A-Z lower-cased word,
    document index, start byte), in text order.  Words never span documents."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(buf):
        return none
    ink = ~_SPACE[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[off] = True
    before = np.concatenate(([False], ink[:-1])) & ~cut[:-1]
    after = np.concatenate((ink[1:], [False])) & ~cut[1:]
    starts, ends = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    if not len(starts):
        return none
    lens = ends - starts
    first = np.cumsum(lens) - lens
    k = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    h = np.add.reduceat(_BYTE[buf[ink]] * _POWERS[k & 0xFFFF], first)
    doc = np.searchsorted(off, starts, side="right") - 1
    return mix(h + lens.astype(np.uint64)), doc, starts


def shingles(word: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of each ``width``-word shingle, grouped by
    document; a document of fewer words gives its whole sequence as one."""
    n = len(word) - width + 1
    h, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        whole = doc[:n] == doc[width - 1:]
        h = word[:n].copy()
        for j in range(1, width):
            h = h * _STEP + word[j:n + j]
        h, d = h[whole], doc[:n][whole]
    ids, first, count = np.unique(doc, return_index=True, return_counts=True)
    short = count < width
    if short.any():
        extra = []
        for i, c in zip(first[short], count[short]):
            s = word[i:i + 1].copy()
            for j in range(1, c):
                s = s * _STEP + word[i + j:i + j + 1]
            extra.append(s)
        h, d = np.concatenate([h, *extra]), np.concatenate([d, ids[short]])
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
    return mix(h), d


def per_document(values: np.ndarray, doc: np.ndarray, n_docs: int) -> Iterator[np.ndarray]:
    """Slices of ``values`` (grouped by document) for documents 0..n_docs-1."""
    edge = np.searchsorted(doc, np.arange(n_docs + 1))
    for i in range(n_docs):
        yield values[edge[i]:edge[i + 1]]
