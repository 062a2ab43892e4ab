"""Corpus pipeline: from raw documents to a weighted training mix.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; it is written as Parquet and read again as the
next stage's documents.  All but the last return the columns of ``documents``.

1. ``quality``: documents that the weak-label scorer rejects go.
2. ``near_dedup``: one document of each near-duplicate group stays (five-word
   shingles, similarity 0.8).
3. ``decontaminate``: documents that contain a benchmark item go.
4. ``secrets``: live-looking credentials are replaced in the text.
5. ``mix``: the mix, a row per epoch of a document; the document at a source's
   cut keeps its first words in its last epoch; documents that contribute no
   words go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import decontam, minhash_dedup, mixing, quality, secrets
from kestrel.llm.scratch import written
from kestrel.session import read_table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.make_mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good_quality),
    ("near_dedup", keep_one_of_each),
    ("decontaminate", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
]

#: the fitted scorer is not expressible in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
