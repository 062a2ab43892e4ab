"""Token counts by rank-synchronous array merging of byte-pair symbols.

A text is cut into pre-tokens as the vocabulary's library cuts it.  The
distinct pre-tokens of a batch are held as one flat symbol array with a
sequence number per symbol.  In each round every sequence applies its lowest
ranked pair, at all of its places at once; sequences without a ranked pair
leave.  A merged symbol's pairs rank after the merge that made it, so a round
never skips a pair that a one-by-one merge would have taken first.  What
survives is counted; no token ids are built.  Pre-tokens of more than
``LONG`` symbols go through the same order of ranks with a list of places per
rank, so that a round costs its own places and not the whole sequence.

Character classes differ between Unicode versions; the driver asks the library
once for the class of every code point, and the tasks follow its answers.  The
merge table (some 50,000 pairs) is broadcast, one copy an executor; texts are
read once and nothing is shuffled.

Memory of a task: ``CHUNK_CHARS`` characters of pre-tokens, or the longest run
of text without a blank if that is more; the counts of pre-tokens seen before
are kept up to ``CACHE_CHARS`` and then dropped.  The longest single pre-token
takes about 60 bytes a byte of it.

Defined results: a null text counts as empty and has no tokens; strings of the
vocabulary's special tokens inside a text are one token each; ids may repeat or
be null, every row is counted; other columns are ignored; empty input gives no
rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 2 << 20
CACHE_CHARS = 8 << 20
LONG = 256

_NONE = np.iinfo(np.int32).max
_BREAK = regex.compile(r"(?<=\S)\s")


@dataclass
class MergeTable:
    """Ranked symbol pairs, in ascending order of ``left * size + right``."""
    size: int
    keys: np.ndarray        # int64
    rank: np.ndarray        # int32, of each key
    merged: np.ndarray      # int32, by rank
    byte_symbol: np.ndarray  # int32, by byte
    specials: list[str]
    not_letters: str        # ranges that the library's older Unicode takes for neither
    _cache: dict[str, int] = field(default_factory=dict)
    _cached: int = 0

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}, "_cached": 0}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    itself where it is printable, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]



def _older_classes(tokenizer) -> str:
    """Code points that ``regex`` takes for letters or numbers and the library
    does not, as ranges of a character set."""
    odd: list[int] = []
    step = 1 << 16
    for lead, kind in (("a", r"\p{L}"), ("1", r"\p{N}")):
        of_kind = regex.compile(kind)
        for lo in range(0, 0x110000, step):
            points = [c for c in range(lo, lo + step) if not 0xD800 <= c < 0xE000 and of_kind.match(chr(c))]
            if not points:
                continue
            # the letter joins the one before it exactly if the library knows it
            cut = tokenizer.pre_tokenizer.pre_tokenize_str("".join(f"{lead}{chr(c)}\x01" for c in points))
            starts = {span[0] for _, span in cut}
            odd += [c for i, c in enumerate(points) if 3 * i + 1 in starts]
    out, odd = [], sorted(odd)
    for i, c in enumerate(odd):
        if i and c == odd[i - 1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@lru_cache(maxsize=4)
def read_merges(path: str) -> MergeTable:
    """The merge table of a byte-level BPE file of the ``tokenizers`` library."""
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut, added = spec["model"], spec["pre_tokenizer"], spec.get("added_tokens") or []
    plain = (model["type"] == "BPE" and spec.get("normalizer") is None and not model.get("ignore_merges")
             and not model.get("byte_fallback") and not model.get("continuing_subword_prefix")
             and not model.get("end_of_word_suffix") and cut and cut["type"] == "ByteLevel" and cut.get("use_regex", True)
             and not cut["add_prefix_space"])
    if not plain or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], np.int64)
    right = np.array([vocab[b] for _, b in pairs], np.int64)
    size = max(vocab.values()) + 1
    order = np.argsort(left * size + right, kind="stable")
    return MergeTable(size, (left * size + right)[order], order.astype(np.int32),
                      np.array([vocab[a + b] for a, b in pairs], np.int32),
                      np.array([vocab[c] for c in _byte_letters()], np.int32),
                      sorted((a["content"] for a in added), key=len, reverse=True), _older_classes(Tokenizer.from_file(path)))


@lru_cache(maxsize=4)
def _cutter(not_letters: str) -> regex.Pattern:
    """Contractions, words, numbers and signs with at most one blank before
    them, runs of white space."""
    minus = f"--[{not_letters}]" if not_letters else ""
    letter, number, sign = rf"[\p{{L}}{minus}]", rf"[\p{{N}}{minus}]", r"[^\s\p{L}\p{N}]"
    if not_letters:
        sign = rf"[[^\s\p{{L}}\p{{N}}]||[{not_letters}]]"
    return regex.compile(rf"'(?:[stmd]|re|ve|ll)| ?(?:{letter}+|{number}+|{sign}+)|\s+(?!\S)|\s+", regex.V1)


def _alternate(linked: np.ndarray) -> np.ndarray:
    """Which places of runs are taken: every other one, from each run's first.
    ``linked[i]``: place i + 1 overlaps place i."""
    at = np.arange(len(linked) + 1)
    first = np.concatenate(([True], ~linked))
    return (at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0


def merge_rounds(table: MergeTable, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Symbols left of each sequence; ``symbols`` holds the sequences one after
    another, ``lengths`` their sizes (at least 1)."""
    left = np.ones(len(lengths), np.int64)
    seq = np.repeat(np.arange(len(lengths)), lengths)
    sym = symbols.astype(np.int32)
    while len(sym):
        rank = np.full(len(sym), _NONE, np.int32)
        rank[:-1] = np.where(seq[1:] == seq[:-1], table.ranks(sym[:-1], sym[1:]), _NONE)
        start = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
        size = np.diff(np.append(start, len(sym)))
        low = np.minimum.reduceat(rank, start)
        done = low == _NONE
        left[seq[start[done]]] = size[done]
        place = np.flatnonzero((rank == np.repeat(low, size)) & (rank < _NONE))
        if not len(place):
            break
        place = place[_alternate(np.diff(place) == 1)]     # a pair that overlaps itself: the first counts
        sym[place] = table.merged[rank[place]]
        stays = np.repeat(~done, size)
        stays[place + 1] = False
        sym, seq = sym[stays], seq[stays]
    return left


def merge_by_rank(table: MergeTable, symbols: np.ndarray) -> int:
    """Symbols left of one long sequence, the places of each rank at a time."""
    n = len(symbols)
    sym = symbols.astype(np.int32)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank = np.full(n, _NONE, np.int32)
    rank[:-1] = table.ranks(sym[:-1], sym[1:])
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def put(places: np.ndarray) -> None:
        places = places[rank[places] < _NONE]
        places = places[np.argsort(rank[places], kind="stable")]
        cut = np.flatnonzero(np.diff(rank[places])) + 1
        for part in np.split(places, cut) if len(places) else []:
            r = int(rank[part[0]])
            if r not in waiting:
                heapq.heappush(heap, r)
            waiting.setdefault(r, []).append(part)

    put(np.arange(n))
    alive = n
    while heap:
        r = heapq.heappop(heap)
        place = np.unique(np.concatenate(waiting.pop(r)))
        place = place[rank[place] == r]
        if not len(place):
            continue
        place = place[_alternate(after[place[:-1]] == place[1:])]
        gone = after[place]
        sym[place] = table.merged[r]
        rank[gone] = _NONE
        after[place] = after[gone]
        inner = after[place] < n
        before[after[place[inner]]] = place[inner]
        alive -= len(place)
        touched = np.concatenate([place, before[place]])
        touched = np.unique(touched[touched >= 0])
        has = after[touched] < n
        rank[touched] = _NONE
        rank[touched[has]] = table.ranks(sym[touched[has]], sym[after[touched[has]]])
        put(touched)
    return alive


def count_pre_tokens(table: MergeTable, words: list[str]) -> np.ndarray:
    """Tokens of each pre-token."""
    raw = [w.encode("utf-8", "replace") for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    out = np.zeros(len(raw), np.int64)
    long = lengths > LONG
    for i in np.flatnonzero(long):
        out[i] = merge_by_rank(table, table.byte_symbol[np.frombuffer(raw[i], np.uint8)])
    short = np.flatnonzero(~long)
    if len(short):
        flat = np.frombuffer(b"".join(raw[i] for i in short), np.uint8)
        out[short] = merge_rounds(table, table.byte_symbol[flat], lengths[short])
    return out


def _pieces(text: str, specials: list[str], chunk: int) -> Iterator[str | None]:
    """Parts of a text, cut at special tokens (each given as None) and, beyond
    ``chunk`` characters, before a blank, where no pre-token spans the cut."""
    parts = regex.split("|".join(map(regex.escape, specials)), text) if any(s in text for s in specials) else [text]
    for i, part in enumerate(parts):
        if i:
            yield None
        lo = 0
        while len(part) - lo > chunk:
            cut = _BREAK.search(part, lo + chunk)
            if not cut:
                break
            yield part[lo:cut.start()]
            lo = cut.start()
        if lo < len(part):
            yield part[lo:]


def _count(table: MergeTable, pieces: list[tuple[int, str]], out: np.ndarray) -> None:
    cut = _cutter(table.not_letters)
    words = [(row, cut.findall(piece)) for row, piece in pieces]
    new = list({w for _, ws in words for w in ws} - table._cache.keys())
    if new:
        table._cache.update(zip(new, count_pre_tokens(table, new).tolist()))
        table._cached += sum(map(len, new)) + 16 * len(new)
    known = table._cache.__getitem__
    for row, ws in words:
        out[row] += sum(map(known, ws))
    if table._cached > CACHE_CHARS:
        table._cache.clear()
        table._cached = 0


def count_texts(table: MergeTable, texts: Iterator[str | None], n: int, chunk: int = CHUNK_CHARS) -> np.ndarray:
    """Tokens of each of ``n`` texts."""
    out = np.zeros(n, np.int64)
    held, size = [], 0
    for row, text in enumerate(texts):
        for piece in _pieces(text or "", table.specials, chunk):
            if piece is None:
                out[row] += 1
                continue
            held.append((row, piece))
            size += len(piece)
            if size >= chunk:
                _count(table, held, out)
                held, size = [], 0
    _count(table, held, out)
    return out


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs`` (doc_id,
    text): UTF-8 bytes, tokens by the vocabulary at ``tokenizer_path`` (read on
    the driver), and whether they are more than ``limit``."""
    shared = docs.sparkSession.sparkContext.broadcast(read_merges(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = count_texts(shared.value, (t.as_py() for t in batch.column(1)), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(n > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce("text", F.lit(""))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"))
