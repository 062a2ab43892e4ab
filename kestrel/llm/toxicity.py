"""Toxicity scoring with a counterfactual-regularised classifier.

A logistic model over hashed words that are present in a text.  Every sampled
text that mentions a group gets counterfactual copies: one for each other term
of the same kind in the mention's place, and one without it.  The loss is the
logistic one plus ``fairness`` times the squared change of the *score* between
a text and each of its copies, in units of ``CHANGE``, so that a neutral mention
of a group does not raise the score; where the rest of a text decides, a swap
changes little and costs little.  A copy differs from its text in two word
buckets, so copies are never held as texts.  The loss is minimised by damped
Gauss-Newton steps; they start where the change of the linear term is penalised
instead, a problem with one minimum.

Only words whose presence differs significantly between the classes get a
weight, so a long text is not judged by how many ordinary words it has.

The fit takes at most ``SAMPLE_DOCS`` labelled texts and ``SAMPLE_BYTES`` of
their packed words, chosen by hash among distinct texts; at most ``MAX_WORDS``
words and the group terms get a weight; the model is a vector of fixed size.

Defined results: an empty or null text scores the base rate of a text without
telling words; labels that are null, or other than 0 and 1, are not learned
from; a document with several labels is learned with each; without labels of
both classes every score is 0; a null id counts as an empty id in the fold
rule; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.scratch import written
from kestrel.llm.text import chunks, per_document, words

BITS = 18
#: documented bound of the fit
SAMPLE_DOCS, SAMPLE_BYTES = 20_000, 48 << 20
MAX_WORDS = 600
#: a swap that changes the score by so much costs ``fairness`` once
CHANGE = 0.05
#: |z| that a word hardly reaches by chance
NOISE_Z = 4.0
#: groups of interchangeable identity terms
IDENTITY_TERMS: Sequence[Sequence[str]] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("gay", "straight"), ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu"), ("muslims", "christians", "jews", "hindus"),
    ("immigrants", "natives"), ("mujeres", "hombres"), ("femmes", "hommes"), ("frauen", "männer"),
)


def _bucket(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(64 - BITS)).astype(np.int64)


def _strip(buf: np.ndarray) -> np.ndarray:
    """Punctuation becomes blank, so that a word is the same with a comma."""
    out = buf.copy()
    out[_PUNCT[buf]] = 32
    return out


_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def present(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, word bucket) pairs, sorted."""
    word, doc, _ = words(_strip(buf), off)
    pair = np.unique((doc << BITS) | _bucket(word))
    return pair >> BITS, pair & ((1 << BITS) - 1)


def term_buckets(groups: Sequence[Sequence[str]]) -> list[list[int]]:
    def of(term: str) -> int:
        buf = np.frombuffer(term.encode(), np.uint8)
        return int(present(buf, np.array([0, len(buf)]))[1][0])
    return [[of(t) for t in group] for group in groups]


@dataclass
class Model:
    bias: float
    weight: np.ndarray   # per bucket

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        doc, bucket = present(buf, off)
        w = self.weight[bucket]
        told = w != 0
        z = self.bias + np.bincount(doc[told], weights=w[told], minlength=len(off) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(train: DataFrame, sample_docs: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Word buckets per sampled text, and its label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch):
                doc, bucket = present(buf, off)
                rows = [r.astype(np.int32).tobytes() for r in per_document(bucket, doc, part.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), part.column(1)], names=["at", "y"])
    found = written(train.select("text", "y").mapInArrow(run, "at binary, y int"), "toxic-sample")
    size = found.agg(F.sum(F.octet_length("at") + 16)).first()[0] or 0
    if size > SAMPLE_BYTES:
        share = int(0.9 * SAMPLE_BYTES / size * (1 << 30))
        found = found.where(F.pmod(F.xxhash64("at", "y"), F.lit(1 << 30)) < share)
    rows = found.limit(sample_docs).collect()
    return [np.frombuffer(r[0], np.int32) for r in rows], np.array([r[1] for r in rows], np.float64)


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_docs: int) -> DataFrame:
    """Distinct (text, y) of ``sample_docs`` labels at most, so that copies of a
    text, or rows that repeat a labelled id, don't fill the sample."""
    y = F.col("y").cast("int")
    chosen = labels.select("doc_id", y.alias("y")).where("doc_id is not null and y in (0, 1)").distinct()
    n = chosen.count()
    if n > sample_docs:
        share = int(0.95 * sample_docs / n * (1 << 30))
        chosen = chosen.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share).limit(sample_docs)
    # at most sample_docs ids and labels
    return (docs.select("doc_id", F.lower("text").alias("text")).join(F.broadcast(chosen), "doc_id")
            .select("text", "y").distinct())


def counterfactuals(x: np.ndarray, terms: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term column, column put in its place or -1) for each copy of a row
    of ``x``: a mentioned term goes, another one of its kind comes (or none)."""
    row, gone, come = [], [], []
    for group in terms:
        for t in group:
            at = np.flatnonzero(x[:, t])
            for u in [-1, *[g for g in group if g != t]]:
                row.append(at)
                gone.append(np.full(len(at), t))
                come.append(np.full(len(at), u))
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(none + part).astype(np.int64) for part in (row, gone, come))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Penalised:
    """The loss with swapped copies, its slope and an upper curvature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, copies: tuple, weight: float, still: np.ndarray):
        self.x, self.y, (self.row, self.gone, self.come), self.weight, self.still = x, y, copies, weight, still
        self.new = (self.come >= 0) & (x[self.row, np.maximum(self.come, 0)] == 0)     # else the text has it already

    def _scores(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = self.x @ w
        swapped = z[self.row] - w[self.gone] + np.where(self.new, w[self.come], 0.0)
        return z, _sigmoid(z), _sigmoid(swapped)

    def loss(self, w: np.ndarray) -> float:
        z, s, t = self._scores(w)
        logistic = np.logaddexp(0, z) - self.y * z
        return float(logistic.mean() + self.weight * ((s[self.row] - t) ** 2).sum() / len(self.y) + self.still @ w**2)

    def step(self, w: np.ndarray, lot: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """(slope, curvature)"""
        n = len(self.y)
        _, s, t = self._scores(w)
        slope = self.x.T @ ((s - self.y) / n) + 2 * self.still * w
        bend = (self.x * (s * (1 - s) / n)[:, None]).T @ self.x + 2 * np.diag(self.still)
        for a in range(0, len(self.row), lot):
            r, gone, come, new = (v[a:a + lot] for v in (self.row, self.gone, self.come, self.new))
            mine, other = s[r] * (1 - s[r]), t[a:a + lot] * (1 - t[a:a + lot])
            change = (mine - other)[:, None] * self.x[r]           # of the score, by each weight
            k = np.arange(len(r))
            change[k, gone] += other
            change[k[new], come[new]] -= other[new]
            slope += 2 * self.weight / n * (change.T @ (s[r] - t[a:a + lot]))
            bend += 2 * self.weight / n * (change.T @ change)
        return slope, bend


def _minimise(problem: _Penalised, w: np.ndarray, steps: int) -> np.ndarray:
    now, damp = problem.loss(w), 1e-6
    for _ in range(steps):
        slope, bend = problem.step(w)
        while damp < 1e6:
            step = np.linalg.solve(bend + damp * (np.diag(np.diag(bend)) + 1e-6 * np.eye(len(w))), slope)
            after = problem.loss(w - step)
            if after <= now:
                break
            damp *= 10
        else:
            break
        w, gain, now, damp = w - step, now - after, after, max(damp / 10, 1e-9)
        if gain <= 1e-10 * max(1.0, now):
            break
    return w


def fit_model(rows: list[np.ndarray], y: np.ndarray, groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
              fairness: float = 5.0, ridge: float = 1e-6, least_z: float = 7.0, max_words: int = MAX_WORDS,
              steps: int = 25) -> Model | None:
    """Logistic regression on the selected words, with the penalty on score
    changes of swapped copies.  ``least_z`` holds for ``SAMPLE_DOCS`` texts; z grows
    with the root of their number, so for fewer it is as much lower, down to
    ``NOISE_Z``."""
    if not len(y) or y.min() == y.max():
        return None
    seen: dict[bytes, int] = {}
    for i, r in enumerate(rows):   # exact copies count once
        seen.setdefault(r.tobytes() + bytes([int(y[i])]), i)
    keep = sorted(seen.values())
    rows, y = [rows[i] for i in keep], y[keep]
    n1, n0 = y.sum(), len(y) - y.sum()
    flat = np.concatenate(rows)
    label = np.repeat(y, [len(r) for r in rows])
    c1 = np.bincount(flat[label == 1], minlength=1 << BITS)
    c0 = np.bincount(flat[label == 0], minlength=1 << BITS)
    p = (c1 + c0 + 1) / (n1 + n0 + 2)
    z = (c1 / n1 - c0 / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    strong = np.argsort(-np.abs(z), kind="stable")[:max_words]
    enough = max(min(least_z, NOISE_Z), least_z * min(1.0, np.sqrt(len(y) / SAMPLE_DOCS)))
    chosen = strong[np.abs(z[strong]) >= enough]
    terms = term_buckets(groups)
    chosen = np.unique(np.concatenate([chosen, [b for g in terms for b in g]]).astype(np.int64))
    column = np.full(1 << BITS, -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((len(rows), len(chosen) + 1), np.float32)    # last column: the bias
    at, row = column[flat], np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    x[row[at >= 0], at[at >= 0]] = 1
    x[:, -1] = 1
    # the start: the change of the linear term as a quadratic form, one term per
    # swap, weighted by how often the term is mentioned
    swap = np.zeros((x.shape[1], x.shape[1]))
    mentioned = x.mean(axis=0)
    for group in terms:
        for t in group:
            for u in [None, *[g for g in group if g != t]]:
                change = np.zeros(x.shape[1])
                change[column[t]] = 1
                if u is not None:
                    change[column[u]] -= 1
                swap += mentioned[column[t]] * np.outer(change, change)
    still = np.full(x.shape[1], ridge)
    still[-1] = 0
    quadratic = 2 * (fairness * swap + np.diag(still))
    w = np.zeros(x.shape[1])
    w[-1] = np.log(n1 / n0)
    for _ in range(steps):     # Newton steps; the loss is convex
        score = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        slope = x.T @ ((score - y) / len(rows)).astype(np.float32) + quadratic @ w
        bend = (x * (score * (1 - score) / len(rows)).astype(np.float32)[:, None]).T @ x
        step = np.linalg.solve(bend + quadratic + 1e-7 * np.eye(len(w)), slope)
        w -= step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
    if fairness:
        columns = [[int(column[t]) for t in group] for group in terms]
        x = x.astype(np.float64)
        w = _minimise(_Penalised(x, y, counterfactuals(x, columns), fairness / CHANGE**2, still), w, 4 * steps)
    b, w = float(w[-1]), w[:-1]
    weight = np.zeros(1 << BITS, np.float32)
    weight[chosen] = w
    return Model(b, weight)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, **options) -> Model | None:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, y)."""
    return fit_model(*_features(labelled_sample(docs, labels, sample_docs), sample_docs), **options)


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) per row of ``docs``."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.score(buf, off))],
                                                 names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.lower("text").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
