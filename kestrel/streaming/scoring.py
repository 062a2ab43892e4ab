"""Scoring a stream of text lines with a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kestrel.functions.parse import parse_delimited
from kestrel.operators.ml import predict
from kestrel.schemas import FEATURE_FIELDS


def parse_stream_lines(lines: DataFrame, fields: Sequence[tuple[str, T.DataType]] = FEATURE_FIELDS,
                       value_col: str = "value", sep: str = ",") -> DataFrame:
    """Kafka/text ``value`` -> typed columns (NULL for short/bad fields)."""
    return parse_delimited(lines, value_col, fields, sep=sep)


def score_stream(model: PipelineModel, rows: DataFrame, out_col: str = "category",
                 invalid: str = "skip") -> DataFrame:
    """Model transform on a streaming frame (a stateless projection chain);
    unseen categorical values are kept by the indexers instead of failing."""
    return predict(model, rows, out_col=out_col, invalid=invalid)
