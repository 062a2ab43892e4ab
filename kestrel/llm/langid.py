"""Language identification by nearest centroid.

A text becomes a unit vector of hashed character n-grams (three bytes of the
lower-cased UTF-8 text, non-letters as blanks) weighted by TF-IDF.  Each
language is described by several centroids, found by spherical k-means over its
training vectors; a text gets the language of the nearest centroid by cosine.
A prediction is *accepted* only if that cosine reaches what the language's own
training texts reach (all but ``reject_share`` of them), less a margin.

Document frequencies are counted over all training documents; the centroids are
fitted on at most ``SAMPLE_DOCS`` of them, spread over the languages.

Defined results: a text that is null or has no letter is ``und`` with score 0;
a null language is never learned from; without any training text all is
``und``; a null id counts as an empty id in the fold rule; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.embed_dedup import fit_cells
from kestrel.llm.scratch import written
from kestrel.llm.text import chunks

DIM = 4096
CENTROIDS = 4
#: documented bounds of the centroid fit
SAMPLE_DOCS = 4_000
SAMPLE_PER_LANGUAGE = 400
CHUNK_ROWS = 512
#: a table of so many languages and counts is broadcast
BROADCAST_LANGUAGES = 10_000

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def gram_counts(buf: np.ndarray, off: np.ndarray, dim: int = DIM) -> np.ndarray:
    """(documents x dim) counts of hashed three-byte grams."""
    n_docs = len(off) - 1
    if len(buf) < 3:
        return np.zeros((n_docs, dim), np.float32)
    b = _LETTER[buf].astype(np.uint32)
    gram = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    doc = np.repeat(np.arange(n_docs), np.diff(off))
    ok = (doc[:-2] == doc[2:]) & (gram != 0x202020)
    bucket = ((gram[ok] * np.uint32(2654435761)) >> np.uint32(32 - (dim.bit_length() - 1))).astype(np.int64)
    flat = np.bincount(doc[:-2][ok] * dim + bucket, minlength=n_docs * dim)
    return flat.reshape(n_docs, dim).astype(np.float32)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.maximum(size, 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centre: np.ndarray       # (k, dim) unit rows
    language: list[str]      # of each centroid
    floor: np.ndarray        # least cosine to accept, per centroid

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the centroid, score, accepted)."""
        dots = weigh(counts, self.idf) @ self.centre.T
        best = np.argmax(dots, axis=1)
        score = np.clip(dots[np.arange(len(best)), best], 0.0, 1.0)
        return best, score.astype(np.float64), score >= self.floor[best]


def _lowered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.lower("text"))


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for part, buf, off in chunks(batch, max_rows=CHUNK_ROWS):
                df += (gram_counts(buf, off) > 0).sum(axis=0)
                n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIM)), pa.array(np.concatenate(([n], df)))],
                                         names=["bucket", "df"])

    rows = (train.select("text").mapInArrow(run, "bucket long, df long")
            .groupBy("bucket").agg(F.sum("df").alias("df")).collect())   # DIM + 1 rows
    df = np.zeros(DIM + 1, np.int64)
    for bucket, value in rows:
        df[bucket] = value
    return df[:-1], int(df[-1])


def _sample(train: DataFrame, sample_docs: int, per_language: int) -> list[tuple[str, np.ndarray]]:
    """Hash-chosen training texts as counts, about ``per_language`` of each
    language and no more than ``sample_docs``."""
    sizes = written(train.groupBy("lang").count(), "languages")
    n_langs = sizes.count()
    if n_langs <= BROADCAST_LANGUAGES:
        sizes = F.broadcast(sizes)
    each = max(1, min(per_language, sample_docs // max(1, n_langs)))
    share = F.least(F.lit(1.0), F.lit(float(each)) / F.col("count"))
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = train.join(sizes.withColumn("share", share), "lang").where(unit < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in chunks(batch, max_rows=CHUNK_ROWS):
                counts = gram_counts(buf, off)
                rows = [np.flatnonzero(c) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.astype(np.int16).tobytes() for r in rows], pa.binary()),
                     pa.array([c[r].tobytes() for c, r in zip(counts, rows)], pa.binary())],
                    names=["lang", "at", "n"])

    out = []
    for lang, at, n in (picked.mapInArrow(run, "lang string, at binary, n binary")
                        .limit(sample_docs).collect()):
        row = np.zeros(DIM, np.float32)
        row[np.frombuffer(at, np.int16)] = np.frombuffer(n, np.float32)
        out.append((lang, row))
    return out


def fit(train: DataFrame, sample_docs: int = SAMPLE_DOCS, per_language: int = SAMPLE_PER_LANGUAGE,
        centroids: int = CENTROIDS, reject_share: float = 0.01, margin: float = 0.05) -> Model | None:
    """Model from ``train`` (doc_id, text, lang); None without training texts."""
    train = _lowered(train.select("doc_id", "text", "lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    df, n = _document_frequencies(train)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(1)
    sample = _sample(train, sample_docs, per_language)
    centre, language, floor = [], [], []
    for lang in sorted({lang for lang, _ in sample}):
        x = weigh(np.stack([row for name, row in sample if name == lang]), idf)
        c = fit_cells(x, centroids)
        near = (x @ c.T).max(axis=1)
        centre.append(c)
        language += [lang] * len(c)
        floor += [float(np.quantile(near, reject_share)) - margin] * len(c)
    return Model(idf, np.concatenate(centre), language, np.array(floor, np.float32))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) per row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, accepted boolean"
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    rows = _lowered(docs.select("doc_id", letters, "text"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("accepted"))
    return rows.mapInArrow(_predictor(model), schema)


def _predictor(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.language, "und"], dtype=object)
        for batch in batches:
            for part, buf, off in chunks(batch, max_rows=CHUNK_ROWS):
                best, score, ok = model.predict(gram_counts(buf, off))
                letters = np.asarray(part.column(1).to_numpy(zero_copy_only=False), bool)
                best = np.where(letters, best, len(names) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names[best], pa.string()), pa.array(np.where(letters, score, 0.0)),
                     pa.array(ok & letters)], names=["doc_id", "lang_pred", "score", "accepted"])
    return run
