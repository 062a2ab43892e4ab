"""Quality classifier trained from weak labels.

Overlapping heuristics (``HEURISTICS``) each vote good, bad or abstain on a
text.  Votes of all documents are counted by pattern, and an
expectation-maximisation over these counts estimates how accurate each
heuristic is and how probable it is that a text with a given pattern is good -
without any true label.  These posteriors label a bounded sample, on which a
linear scorer over hashed features is trained; the scorer judges every text.

There are at most 3 ** len(HEURISTICS) vote patterns whatever the number of
documents, so the estimate needs one pass and a small table.

Defined results: a null or empty text has no evidence against it, nor for it:
all heuristics abstain, it gets score 0.5 and is kept, as is everything when
there is nothing to learn from; rows that repeat get equal scores; other
columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.text import chunks, mix, words

ABSTAIN, BAD, GOOD = 0, 1, 2
BITS = 12
#: documented bound of the scorer's fit
SAMPLE_DOCS = 4_000
CHUNK_ROWS = 2_048

_KIND = np.zeros(256, np.int64)            # 0 other
_KIND[97:123], _KIND[65:91] = 1, 2         # lower, upper
_KIND[128:] = 1                            # letters beyond ASCII
_KIND[48:58] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in "#$%&*|!<>{}[]=^~_\\/@+"]] = 5
_KIND[[ord(c) for c in ".,;:?'\"-()"]] = 6

#: name -> (statistic, bad from, good up to): the vote is bad at or above the
#: first bound, good at or below the second, none between
HEURISTICS: dict[str, tuple[str, float, float]] = {
    "symbols": ("symbol_share", 0.05, 0.01),
    "symbol_words": ("symbol_words", 0.20, 0.05),
    "shouting": ("upper_share", 0.50, 0.15),
    "repeated_words": ("repeats", 0.70, 0.45),
    "repeated_neighbours": ("neighbours", 0.20, 0.08),
    "word_length": ("odd_length", 0.50, 0.25),
    "digits": ("digit_share", 0.30, 0.10),
}
#: texts of fewer words give no vote on repetition and word length
LEAST_WORDS = 8


def statistics(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The heuristics' statistics per document; nan where there is no evidence."""
    n_docs = len(off) - 1
    kind = _KIND[buf]
    doc = np.repeat(np.arange(n_docs), np.diff(off))
    by = np.bincount(doc * 7 + kind, minlength=n_docs * 7).reshape(n_docs, 7).astype(float)
    ink = by.sum(axis=1) - by[:, 4]
    letters = by[:, 1] + by[:, 2]
    word, wdoc, start = words(buf, off)
    n = np.bincount(wdoc, minlength=n_docs).astype(float)
    order = np.lexsort((word, wdoc))
    first = np.ones(len(word), bool)
    first[1:] = (word[order][1:] != word[order][:-1]) | (wdoc[order][1:] != wdoc[order][:-1])
    distinct = np.bincount(wdoc[order][first], minlength=n_docs)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (wdoc[1:] == wdoc[:-1])
    symbol = np.concatenate(([0], np.cumsum(kind == 5)))
    blank = np.concatenate(([0], np.cumsum(kind != 4)))
    after = np.concatenate((start[1:], [len(buf)])) if len(start) else start
    has_symbol = symbol[after] > symbol[start]
    size = blank[after] - blank[start]
    odd = (size < 2) | (size > 24)
    per_word = lambda flag: np.bincount(wdoc[flag], minlength=n_docs)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = {"symbol_share": by[:, 5] / ink, "symbol_words": per_word(has_symbol) / n,
               "upper_share": by[:, 2] / letters, "digit_share": by[:, 3] / ink,
               # in long texts words come back anyway: expect about sqrt(n) times a constant
               "repeats": 1 - distinct / np.minimum(n, 6 * np.sqrt(n)),
               "neighbours": per_word(same) / n, "odd_length": per_word(odd) / n}
    for k in ("symbol_words", "repeats", "neighbours", "odd_length"):
        out[k] = np.where(n >= LEAST_WORDS, out[k], np.nan)
    return out


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """(documents x heuristics) votes."""
    out = []
    for stat, bad, good in HEURISTICS.values():
        v = stats[stat]
        with np.errstate(invalid="ignore"):
            out.append(np.where(v >= bad, BAD, np.where(v <= good, GOOD, ABSTAIN)))
    return np.stack(out, axis=1) if out else np.zeros((0, 0), int)


def pattern_code(v: np.ndarray) -> np.ndarray:
    return (v * 3 ** np.arange(v.shape[1])).sum(axis=1)


def label_model(codes: np.ndarray, counts: np.ndarray, n_votes: int, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: (posterior of good per pattern, chances).

    Votes are independent given the true class, and an abstention tells nothing.
    ``chance[j]`` holds the chance of each vote of heuristic j given the class,
    if it votes.  It starts from what such
    heuristics are written for: a fault is rarely seen in a good text, and a
    bad text has one or two of the faults, not all."""
    v = (codes[:, None] // 3 ** np.arange(n_votes)) % 3
    says = np.stack([v == BAD, v == GOOD], axis=2).astype(float)       # pattern, heuristic, vote
    chance = np.zeros((n_votes, 2, 2))                                 # heuristic, class, vote
    chance[:, 0], chance[:, 1] = [0.35, 0.65], [0.02, 0.98]            # class bad, class good
    prior = np.array([0.2, 0.8])
    post = np.zeros((len(codes), 2))
    for _ in range(rounds):
        logp = np.log(prior) + np.einsum("pjv,jcv->pc", says, np.log(chance))
        post = np.exp(logp - logp.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        mass = post * counts[:, None]
        chance = np.einsum("pc,pjv->jcv", mass, says) + 0.5
        # a heuristic is better than chance by construction: its bad votes are
        # no likelier for good texts than for bad ones
        chance /= chance.sum(axis=2, keepdims=True)
        flip = chance[:, 1, 0] > chance[:, 0, 0]
        chance[flip] = chance[flip].mean(axis=1, keepdims=True)
        prior = (mass.sum(axis=0) + 1) / (mass.sum() + 2)
    return post[:, 1], chance


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents x 2 ** BITS) unit rows: hashed byte grams, plus hashed bins of
    the statistics."""
    n_docs, dim = len(off) - 1, 1 << BITS
    out = np.zeros((n_docs, dim), np.float32)
    if len(buf) >= 3:
        b = buf.astype(np.uint32)
        kind = _KIND[buf].astype(np.uint32)
        doc = np.repeat(np.arange(n_docs), np.diff(off))
        inside = doc[:-2] == doc[2:]
        for code in ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:],
                     (kind[:-2] * 49 + kind[1:-1] * 7 + kind[2:]) | np.uint32(1 << 24)):
            bucket = ((code[inside] * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
            flat = np.bincount(doc[:-2][inside] * dim + bucket, minlength=n_docs * dim)
            part = np.sqrt(flat.reshape(n_docs, dim).astype(np.float32))
            out += part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
    for j, value in enumerate(statistics(buf, off).values()):
        step = np.where(np.isnan(value), -2, np.clip(np.nan_to_num(value) * 20, -1, 20)).astype(np.int64)
        key = mix((np.full(n_docs, j + 1, np.uint64) << np.uint64(32)) | (step + 3).astype(np.uint64))
        bucket = (key >> np.uint64(64 - BITS)).astype(np.int64)
        out[np.arange(n_docs), bucket] += 1.0
    return out


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        z = features(buf, off) @ self.weight + self.bias
        empty = np.diff(off) == 0
        return np.where(empty, 0.5, 1 / (1 + np.exp(-np.clip(z, -30, 30)))).astype(np.float64)


def vote_table(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns of all documents and how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for _, buf, off in chunks(batch, max_rows=CHUNK_ROWS):
                code, n = np.unique(pattern_code(votes(statistics(buf, off))), return_counts=True)
                for c, k in zip(code.tolist(), n.tolist()):
                    seen[c] = seen.get(c, 0) + k
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                         names=["code", "n"])
    rows = (docs.select("text").mapInArrow(run, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).collect())   # at most 3 ** len(HEURISTICS) rows
    rows = sorted((r[0], r[1]) for r in rows)
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)


def sample_texts(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(text): distinct texts, chosen by hash, about nine tenths of
    ``sample_docs`` of them or all; copies count once."""
    texts = docs.select("text").where("text <> ''")
    n = texts.select(F.xxhash64("text").alias("h")).distinct().count()
    share = min(1.0, 0.9 * sample_docs / max(1, n))
    unit = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))
    return texts.where(unit).distinct()


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, steps: int = 150, ridge: float = 1e-4) -> Model | None:
    """The scorer for ``docs`` (text, ...); None for an empty table."""
    codes, counts = vote_table(docs)
    if not len(codes):
        return None
    posterior, _ = label_model(codes, counts, len(HEURISTICS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, buf, off in chunks(batch, max_rows=256):
                code = pattern_code(votes(statistics(buf, off)))
                x = features(buf, off)
                at = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(posterior[np.searchsorted(codes, code)]),
                     pa.array([i.astype(np.int16).tobytes() for i in at], pa.binary()),
                     pa.array([r[i].tobytes() for r, i in zip(x, at)], pa.binary())], names=["p", "at", "x"])

    rows = (sample_texts(docs, sample_docs)
            .mapInArrow(run, "p double, at binary, x binary").limit(sample_docs).collect())
    if not rows:
        return None
    x = np.zeros((len(rows), 1 << BITS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r[1], np.int16)] = np.frombuffer(r[2], np.float32)
    y = np.array([r[0] for r in rows])
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, c, t = w.copy(), b, 1.0
    rate = 1 / (0.25 * float((x ** 2).sum(axis=1).max() + 1) + ridge)
    for _ in range(steps):
        miss = 1 / (1 + np.exp(-np.clip(x @ v + c, -30, 30))) - y
        w_new = v - rate * (x.T @ miss.astype(np.float32) / len(y) + ridge * v)
        b_new = c - rate * float(miss.mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_new + np.float32((t - 1) / t_new) * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return Model(w, float(b))


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, bad_votes, good_votes) per row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch, max_rows=CHUNK_ROWS // 8):
                v = votes(statistics(buf, off))
                score = model.score(buf, off) if model else np.full(part.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score), pa.array((v == BAD).sum(axis=1), pa.int64()),
                     pa.array((v == GOOD).sum(axis=1), pa.int64())],
                    names=["doc_id", "score", "bad_votes", "good_votes"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, bad_votes long, good_votes long")


def keep_good(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that the model scores below ``least``; no shuffle."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch, max_rows=CHUNK_ROWS // 8):
                yield part.filter(pa.array(model.score(buf, off) >= least))

    return docs.mapInArrow(run, docs.schema)
