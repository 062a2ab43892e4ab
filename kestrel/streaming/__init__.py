"""Structured Streaming: sources, windowed rates, model scoring, idempotent sinks."""

from kestrel.streaming.sources import kafka_lines, parquet_table_stream, text_lines_stream
from kestrel.streaming.rate import bucket_rate, window_rate
from kestrel.streaming.sinks import (read_current, run_append_by_batch, run_complete_overwrite,
                                     use_rocksdb_state)
from kestrel.streaming.scoring import parse_stream_lines, score_stream

__all__ = [n for n in dir() if not n.startswith("_")]
