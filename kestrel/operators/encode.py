"""Dictionary encoding of categorical columns without a value list on the driver.

The index of a value is its place in (count descending, value ascending), as
``StringIndexer`` numbers it, but the dictionary stays a table: values are
counted in one pass over all columns, ranked by a distributed global index, and
written next to the model.  Rows meet it by joins:

* the commonest values (the first ``hot_rows`` places, if no longer than
  ``HOT_BYTES``) are broadcast, so a value that a third of all rows hold never
  moves; their number and size are bounded whatever the dictionary's;
* the other values are shuffled.  Rows that already have their index, or hold
  no value, are dealt out by a salt and not by their key.

A dictionary within the bound is broadcast as a whole and nothing is shuffled.
A value that the dictionary lacks, or NULL, gets the reserved index (one past
the last), or NULL, or its row is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.ml import forest, global_index, load_model, predict, save_model, train_model

HOT_ROWS = 20_000
HOT_BYTES = 1_024
WORK = "__encode_"


@dataclass(frozen=True)
class Dictionaries:
    """Written dictionaries: a row (position of the column, value, idx, n) each,
    and the number of values of every column."""
    path: str
    columns: tuple[str, ...]
    sizes: tuple[int, ...]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("c int, value string, idx long, n long").parquet(f"{self.path}/values")

    def column(self, spark: SparkSession, column: str) -> DataFrame:
        """(value, idx, n) of one column."""
        return self.table(spark).where(F.col("c") == self.columns.index(column)).drop("c")


def fit_dictionaries(df: DataFrame, columns: Sequence[str], path: str) -> Dictionaries:
    """Count, rank and write the values of ``columns`` (as strings; NULL has no
    entry) under ``path``, replacing what is there."""
    spark = df.sparkSession
    if len(set(columns)) < len(columns):
        raise ValueError(f"repeated columns: {list(columns)}")
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)])
    counts = (df.select(F.inline(pairs)).where("value is not null").groupBy("c", "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = global_index(counts, [F.col("c"), F.col("n").desc(), F.col("value")], "place")
    starts = ranked.groupBy("c").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("size"))   # a row per column
    (ranked.join(F.broadcast(starts), "c").select("c", "value", (F.col("place") - F.col("start")).alias("idx"), "n")
     .write.mode("overwrite").partitionBy("c").parquet(f"{path}/values"))
    found = {r["c"]: r["size"] for r in starts.collect()}
    sizes = [(i, c, found.get(i, 0)) for i, c in enumerate(columns)]
    spark.createDataFrame(sizes, "c int, name string, size long").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    return load_dictionaries(spark, path)


def load_dictionaries(spark: SparkSession, path: str) -> Dictionaries:
    rows = spark.read.parquet(f"{path}/columns").orderBy("c").collect()
    return Dictionaries(path, tuple(r["name"] for r in rows), tuple(r["size"] for r in rows))


def _indexed(df: DataFrame, words: DataFrame, size: int, column: str, out: str, hot_rows: int) -> DataFrame:
    """``df`` with the place of ``column``'s value in ``out`` (NULL if it has none)."""
    value = F.col(f"`{column}`").cast("string")
    is_hot = (F.col("idx") < hot_rows) & (F.octet_length("value") <= HOT_BYTES)
    hot = words.where(is_hot).select(F.col("value").alias(f"{WORK}hot"), F.col("idx").alias(out))
    df = df.withColumn(f"{WORK}value", value).join(F.broadcast(hot), F.col(f"{WORK}value") == F.col(f"{WORK}hot"), "left")
    df = df.drop(f"{WORK}hot")
    if size <= hot_rows and words.where(~is_hot).isEmpty():
        return df.drop(f"{WORK}value")
    open_ = F.col(out).isNull() & F.col(f"{WORK}value").isNotNull()
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one key column: a constant second one would be folded out of the join's keys
    salt = F.concat(F.lit("#"), F.pmod(F.monotonically_increasing_id(), F.lit(16 * width)))
    df = df.withColumn(f"{WORK}key", F.when(open_, F.concat(F.lit("="), F.col(f"{WORK}value"))).otherwise(salt))
    rest = words.where(~is_hot).select(F.concat(F.lit("="), F.col("value")).alias(f"{WORK}cold"), F.col("idx").alias(f"{WORK}idx"))
    df = df.join(rest, F.col(f"{WORK}key") == F.col(f"{WORK}cold"), "left")
    return df.withColumn(out, F.coalesce(out, f"{WORK}idx")).drop(*[f"{WORK}{c}" for c in ("value", "key", "cold", "idx")])


def encode_rows(df: DataFrame, dictionaries: Dictionaries, columns: Sequence[str] | None = None, unseen: str = "keep",
                suffix: str = "_index", hot_rows: int = HOT_ROWS, max_nominal: int | None = None) -> DataFrame:
    """``df`` with a double column ``<column><suffix>`` for each of ``columns``
    (all of the dictionaries').  ``unseen`` values and NULLs: 'keep' gives the
    reserved index (the number of known values), 'null' NULL, 'skip' leaves the
    row out.  With ``max_nominal``, a column of fewer indexes is marked as
    nominal for Spark ML's trees (the others stay frequency ranks)."""
    if unseen not in ("keep", "null", "skip"):
        raise ValueError(f"unseen is keep, null or skip, not {unseen!r}")
    columns = list(dictionaries.columns if columns is None else columns)
    clash = [c for c in df.columns if c.startswith(WORK) or c in [f"{x}{suffix}" for x in columns]]
    if clash:
        raise ValueError(f"the rows already have the columns {clash}")
    for c in columns:
        size, out = dictionaries.sizes[dictionaries.columns.index(c)], f"{c}{suffix}"
        df = _indexed(df, dictionaries.column(df.sparkSession, c), size, c, out, hot_rows)
        if unseen == "skip":
            df = df.where(F.col(f"`{out}`").isNotNull())
        index = F.col(f"`{out}`") if unseen != "keep" else F.coalesce(F.col(f"`{out}`"), F.lit(size))
        df = df.withColumn(out, index.cast("double"))
        if max_nominal and size + 1 <= max_nominal:
            df = df.withMetadata(out, {"ml_attr": {"type": "nominal", "name": out, "num_vals": size + 1}})
    return df


@dataclass(frozen=True)
class EncodedModel:
    """A fitted pipeline with the dictionaries of its categorical columns."""
    pipeline: PipelineModel
    dictionaries: Dictionaries

    def predict(self, df: DataFrame, out_col: str = "category", **kw) -> DataFrame:
        """Score rows that hold the categorical columns themselves."""
        made = [f"{c}{WORK}" for c in self.dictionaries.columns]
        scored = predict(self.pipeline, encode_rows(df, self.dictionaries, suffix=WORK), out_col=out_col, **kw)
        return scored.drop(*made)


def train_encoded(df: DataFrame, path: str, categorical: Sequence[str], label_col: str = "category",
                  exclude: Sequence[str] = (), max_nominal: int = 1_000, seed: int = 7, **kw) -> EncodedModel:
    """Fit dictionaries and forest on the labelled rows and save both under
    ``path``.  Columns of up to ``max_nominal`` indexes are nominal features
    (the trees get as many bins); longer ones enter by frequency rank."""
    labelled = df.where(F.col(label_col).isNotNull())
    dictionaries = fit_dictionaries(labelled, categorical, f"{path}/dictionaries")
    rows = encode_rows(labelled, dictionaries, suffix=WORK, max_nominal=max_nominal)
    nominal = [s + 1 for s in dictionaries.sizes if s + 1 <= max_nominal]
    trees: RandomForestClassifier = forest(seed)
    trees.setMaxBins(max([trees.getMaxBins(), *nominal]))
    model = train_model(rows, label_col=label_col, categorical=[], exclude=[*exclude, *categorical], classifier=trees, **kw)
    save_model(model, f"{path}/pipeline")
    return EncodedModel(model, dictionaries)


def load_encoded(spark: SparkSession, path: str) -> EncodedModel:
    return EncodedModel(load_model(f"{path}/pipeline"), load_dictionaries(spark, f"{path}/dictionaries"))
