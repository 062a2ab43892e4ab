"""String indexing, random-forest training and scoring (Spark ML).

Faithful defaults: frequency-ordered string indexes (ties alphabetical),
numeric features only, invalid feature rows skipped, RandomForest defaults.

The stages read copies of the feature columns and write columns of their own,
all named with ``WORK``; scoring drops exactly these, and every column of the
caller's stays, whatever its name.

Invalid (NULL/NaN) feature rows are handled on these copies (``invalid``) by
per-column expressions rather than by ``VectorAssembler(handleInvalid='skip')``:
the latter adds one ``atleastnnonnulls(all features)`` predicate, and when the
features are parsed expressions (a stream of text lines) Catalyst's constraint
inference substitutes every alias into it, which grows as 2^columns.  A
conjunction of per-column predicates infers linearly.
Differences that fix known failures are parameters: unseen categorical values
are kept (``handleInvalid='keep'``) rather than failing a stream, and the
label decoder never collides with an existing column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.metrics import binary_metrics

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.BooleanType)


def global_index(df: DataFrame, order: list, out_col: str = "idx") -> DataFrame:
    """0-based position of each row in a total ``order``, computed without
    gathering rows into one task.

    The sort is range-partitioned (distributed); each row's id from
    ``monotonically_increasing_id`` encodes its sorted partition and its local
    position; the per-partition row counts (one row per partition, bounded by
    the partition count, so the broadcast is size-proven) give each
    partition's offset.  The order must be total for the result to be
    deterministic.

    The numbered rows are written once with a reliable ``checkpoint()``
    (eager, into the shared ``spark.checkpoint.dir``) before they feed both
    the counts and the rows: the range bounds come from sampling rows in
    arrival order, so two separately planned sorts could split partitions
    differently, and offsets from one would then not fit the other.
    """
    from kestrel.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    mid = F.monotonically_increasing_id()
    ranked = df.orderBy(*order).withColumn("__mid", mid).withColumns({
        "__part": F.shiftright(F.col("__mid"), 33),
        "__local": F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))}).checkpoint(eager=True)
    counts = ranked.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return (ranked.join(F.broadcast(offsets), on="__part")
            .withColumn(out_col, F.col("__off") + F.col("__local"))
            .drop("__mid", "__part", "__local", "__off"))


def string_index_table(df: DataFrame, column: str, out_col: str = "idx",
                       count_col: str = "n") -> DataFrame:
    """The index ``StringIndexer(stringOrderType='frequencyDesc')`` assigns:
    position in (count desc, value asc), as a double.

    Counting is a partial aggregate (skew-safe); the ranking is a distributed
    global index over the distinct values (``global_index``), so even a
    high-cardinality column is never gathered into one task.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias(count_col))
    ranked = global_index(counts, [F.col(count_col).desc(), F.col(column).asc()], "__i")
    return ranked.withColumn(out_col, F.col("__i").cast("double")).drop("__i")


def numeric_feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in ex]


WORK = "__ml_"
_LABEL, _FEATURES = f"{WORK}label", f"{WORK}features"
_RAW, _INDEX = f"{WORK}raw_", f"{WORK}index_"


def forest(seed: int = 7) -> RandomForestClassifier:
    """The default classifier, on the pipeline's working columns."""
    return RandomForestClassifier(
        featuresCol=_FEATURES, labelCol=_LABEL, predictionCol=f"{WORK}prediction",
        probabilityCol=f"{WORK}probability", rawPredictionCol=f"{WORK}raw", seed=seed)


def build_pipeline(df: DataFrame, label_col: str = "category",
                   categorical: Sequence[str] = ("protocol_type", "service", "flag"),
                   exclude: Sequence[str] = ("attack",),
                   use_categoricals: bool = False, classifier=None,
                   handle_invalid: str = "keep", seed: int = 7) -> Pipeline:
    """Label indexer, categorical indexer (if used), assembler, classifier.

    With ``use_categoricals`` the indexed columns carry nominal metadata, so
    the forest needs ``maxBins`` at least the largest category count (plus
    the index ``handleInvalid='keep'`` reserves for unseen values).  Those
    counts come from one aggregate over the categorical columns (one row to
    the driver) and raise the default of 32 where needed.  All categorical
    columns share one indexer, i.e. one pass."""
    present_cats = [c for c in categorical if c in df.columns]
    stages = [StringIndexer(inputCol=label_col, outputCol=_LABEL, handleInvalid="skip")]
    numeric = numeric_feature_columns(df, exclude=[label_col, *exclude, *present_cats])
    features = [f"{_RAW}{c}" for c in numeric]
    if use_categoricals and present_cats:
        indexed = [f"{_INDEX}{c}" for c in present_cats]
        stages.append(StringIndexer(inputCols=present_cats, outputCols=indexed, handleInvalid=handle_invalid))
        features += indexed
    stages.append(VectorAssembler(inputCols=features, outputCol=_FEATURES, handleInvalid="keep"))
    clf = classifier
    if clf is None:
        clf = forest(seed)
        if use_categoricals and present_cats:
            sizes = df.agg(*[F.count_distinct(c) for c in present_cats]).first()
            clf.setMaxBins(max(clf.getMaxBins(), max(sizes) + 1))
    stages.append(clf)
    return Pipeline(stages=stages)


def feature_columns(stages) -> list[str]:
    """The caller's numeric columns that the stages read."""
    assembler = next(s for s in stages if isinstance(s, VectorAssembler))
    return [c[len(_RAW):] for c in assembler.getInputCols() if c.startswith(_RAW)]


def _check_invalid(invalid: str) -> None:
    if invalid not in ("skip", "keep", "impute"):
        raise ValueError(f"invalid is skip, keep or impute, not {invalid!r}")


def _invalid(columns: Sequence[str]) -> Column:
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return bad


def _with_features(df: DataFrame, columns: Sequence[str], invalid: str, fill: float) -> DataFrame:
    """Add the copies of the feature columns that the assembler reads."""
    _check_invalid(invalid)
    clash = [c for c in df.columns if c.startswith(WORK)]
    if clash:
        raise ValueError(f"columns named {WORK}... are reserved: {clash}")
    if invalid == "skip":
        # one predicate per column (see the module docstring)
        for c in columns:
            df = df.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
        return df.withColumns({f"{_RAW}{c}": F.col(c) for c in columns})
    filled = {f"{_RAW}{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(float(fill))), F.lit(float(fill)))
              for c in columns}
    return df.withColumns(filled | ({f"{WORK}bad": _invalid(columns)} if invalid == "keep" else {}))


def train_model(df: DataFrame, label_col: str = "category", invalid: str = "skip", fill: float = 0.0,
                partitions: int | None = None, **kw) -> PipelineModel:
    """Fit the pipeline.  The fit scans its input several times (one pass per
    indexer, then the forest's setup passes) before the forest caches its own
    binned copy, so only the columns the stages read are persisted for the
    duration of the fit (MEMORY_AND_DISK; a lost block is recomputed from
    lineage) and released afterwards.  The input itself is read once.

    Rows without label can't be learned from and are left out; rows with a
    NULL or NaN feature are left out too (``invalid`` 'skip' or 'keep') or take
    ``fill`` for it ('impute'); ``filters.invalid_feature_counts`` reports how
    many they are.

    The forest bootstraps per partition, so its model depends on the input's
    partitions; give ``partitions`` to fix their number (one shuffle), e.g.
    for a single unsplittable file."""
    pipeline = build_pipeline(df, label_col=label_col, **kw)
    stages = pipeline.getStages()
    numeric = feature_columns(stages)
    read = [label_col, *numeric]
    for s in stages[1:]:
        if isinstance(s, StringIndexer):
            read += s.getInputCols()
    _check_invalid(invalid)
    data = df.select(*dict.fromkeys(read))
    data = _with_features(data.where(F.col(label_col).isNotNull()), numeric,
                          "impute" if invalid == "impute" else "skip", fill)
    if partitions:
        data = data.repartition(partitions)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(data)
    finally:
        data.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, out_col: str = "category", invalid: str = "skip",
            fill: float = 0.0) -> DataFrame:
    """``df`` with the predicted label in ``out_col`` (replaced if there).

    The label indexer (the model's first stage) is not run, so labelled and
    unlabelled rows are scored alike.  Rows with a NULL or NaN feature are left
    out ('skip'), stay with a NULL prediction ('keep'), or are scored with
    ``fill`` in its place ('impute'); ``filters.invalid_feature_counts`` over
    ``feature_columns(model.stages)`` reports how many they are.
    """
    stages = model.stages
    numeric = feature_columns(stages)
    rows = df if out_col in numeric else df.drop(out_col)
    scored = PipelineModel(stages=stages[1:]).transform(_with_features(rows, numeric, invalid, fill))
    prediction, label = stages[-1].getPredictionCol(), f"{WORK}predicted"
    decoded = IndexToString(inputCol=prediction, outputCol=label, labels=stages[0].labels).transform(scored)
    value = F.col(label)
    if invalid == "keep":
        value = F.when(~F.col(f"{WORK}bad"), value)
    names = [c for c in rows.columns if c != out_col]
    return decoded.select(*[F.col(f"`{c}`") for c in names], value.alias(out_col))


def holdout_metrics(df: DataFrame, label_col: str = "category", negative: str = "normal",
                    train_fraction: float = 0.75, seed: int = 7,
                    split_keys: Sequence[str] | None = None, **kw) -> DataFrame:
    """Split, fit on train, score validation, report binary metrics with every
    class other than ``negative`` collapsed to positive.  Compares label
    *strings*, so it does not depend on which index the negative class got.

    The split is ``randomSplit`` as in the surveyed code: its rows depend on
    the input's partitioning, and Spark puts a local sort on every column
    under each side's sample to make it repeatable, i.e. two sorts of the
    whole input.  With ``split_keys`` it is a seeded hash of those columns
    instead: the same rows land in each side on any cluster layout, with no
    sort and no shuffle (the form to use on large inputs)."""
    if split_keys:
        from kestrel.operators.sampling import hash_split
        tagged = hash_split(df, [train_fraction, 1 - train_fraction], split_keys, seed=seed,
                            names=["train", "valid"], out_col="__split")
        train = tagged.where(F.col("__split") == "train").drop("__split")
        valid = tagged.where(F.col("__split") == "valid").drop("__split")
    else:
        train, valid = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
    model = train_model(train, label_col=label_col, seed=seed, **kw)
    scored = predict(model, valid.withColumnRenamed(label_col, "__truth"), out_col="__pred")
    return binary_metrics(scored, "__pred", "__truth", negative)
