"""Train-and-save and batch scoring compositions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.ml import load_model, predict, save_model, train_model
from kestrel.plans.etl import prepare


def train_on_full_data(raw: DataFrame, model_path: str, preset: str = "v2",
                       processed_path: str | None = None, label_col: str = "category",
                       raw_path: str | None = None, **etl_kw) -> PipelineModel:
    """(write raw) -> ETL -> (write processed) -> fit -> save.  What is written
    is re-read for the next step: the written table cuts the lineage, so an
    executor lost during the (many-job) fit recomputes from the table, not
    from the raw log."""
    if raw_path:
        raw.write.mode("overwrite").parquet(raw_path)
        raw = raw.sparkSession.read.parquet(raw_path)
    processed = prepare(raw, preset, **etl_kw)
    if processed_path:
        processed.write.mode("overwrite").parquet(processed_path)
        processed = raw.sparkSession.read.parquet(processed_path)
    model = train_model(processed, label_col=label_col)
    save_model(model, model_path)
    return model


def batch_score(model_path: str, rows: DataFrame, out_col: str = "category", raw_path: str | None = None,
                processed_path: str | None = None, invalid: str = "skip") -> DataFrame:
    """(append raw) -> load model -> score -> (append processed).

    The scored rows are appended with the columns, order and types that
    ``processed_path`` already has: a column it lacks is an error, one that the
    rows lack is NULL."""
    spark = rows.sparkSession
    if raw_path:
        rows.write.mode("append").parquet(raw_path)
    scored = predict(load_model(model_path), rows, out_col=out_col, invalid=invalid)
    if processed_path:
        scored = aligned(scored, spark.read.parquet(processed_path).schema)
        scored.write.mode("append").parquet(processed_path)
    return scored


def batch_score_once(model, rows: DataFrame, table_path: str, keys, run: str, out_col: str = "category",
                     invalid: str = "skip", buckets: int = 64) -> DataFrame:
    """Score the rows whose ``keys`` the table at ``table_path`` does not hold
    yet and commit them as one run; the table is returned.

    Runs may overlap and may be repeated: a key is scored and stored once, a
    run that is committed is skipped, one that died is simply run again.
    ``model`` is a fitted pipeline, an ``EncodedModel``, or the path of a saved
    pipeline.  Rows left out for invalid features are looked at again by the
    next run that brings them."""
    from kestrel.sources.manifest import ManifestTable
    if isinstance(model, str):
        model = load_model(model)
    score = getattr(model, "predict", None) or (lambda df, **kw: predict(model, df, **kw))
    table = ManifestTable(rows.sparkSession, table_path, buckets)
    table.append_unseen(rows, keys, run, transform=lambda df: score(df, out_col=out_col, invalid=invalid))
    return table.read()


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``."""
    extra = [c for c in df.columns if c not in schema.names]
    if extra:
        raise ValueError(f"the table has no columns {extra}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
