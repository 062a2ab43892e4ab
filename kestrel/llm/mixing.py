"""Mixing sources to target weights.

Each document gets a hash-random key.  Within its source the documents are
ordered by key; prefix sums of word counts find the document at which the
source's budget is used up.  A budget above the source's size repeats whole
epochs first.

The prefix sums are two-level: every source is cut into ranges of the key
(all rows of a range fit one task, however large the source), the ranges' sums
are accumulated, and only then are the rows inside each range summed.  What
comes out is one small *cut* per source, so the texts themselves are never
shuffled: ``mix`` reads them once more and compares their key with the cut.
``make_mix`` repeats and cuts the documents accordingly.

Defined results: a null text has size 0 and is taken 0 times; a null source is
a source of its own, sorted last; empty input gives an empty result; rows that
agree in id and text share one place in the order and, at the cut, an equal
share; other columns pass through (names ``size, source_size, target, taken``
are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.hashing import hash_key
from kestrel.llm.prefix import running_sums
from kestrel.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
GAP_AND_WORD = r"[\x20\x09-\x0D]*" + WORD
KEY_BITS = 60
#: rows of one key range; a range is what one task sorts
ROWS_PER_RANGE = 512
#: a table of source cuts up to this many rows is broadcast (about 100 bytes a row)
BROADCAST_SOURCES = 100_000

_PLACE = ("__key", "__id", "__tie")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    """doc columns -> source, size and place in the order."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.withColumns({
        "size": word_count(F.col("text")),
        "__src": F.coalesce(F.col("source"), F.lit("")), "__nosrc": F.col("source").isNull(),
        "__key": hash_key(seed, ident), "__id": ident,
        "__tie": F.coalesce(F.xxhash64("text"), F.lit(0))})


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(__nosrc, __src, source_size) -> the same with ``target``: ``share`` of
    all words, dealt by weight, no source above ``most`` times its size.

    A source is full where the words dealt at its own ratio of cap to weight
    still fit the total; what is left is dealt by weight among the others."""
    ranked = running_sums(sizes.withColumn("__one", F.lit(1)), ["__nosrc", "__src"], {"__rank": "__one"})
    cases = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.pmod(F.col("__rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumns({"__w": cases, "__cap": F.col("source_size") * F.lit(float(most))})
    ranked = ranked.withColumn("__ratio", F.col("__cap") / F.col("__w"))
    summed = running_sums(ranked, ["__ratio", "__nosrc", "__src"], {"__caps": "__cap", "__ws": "__w"})
    total, weight = ranked.agg(F.sum("source_size"), F.sum("__w")).first()
    goal = share * (total or 0)
    full = F.col("__caps") + F.col("__ratio") * (F.lit(weight or 0.0) - F.col("__ws")) <= F.lit(goal)
    summed = summed.withColumn("__full", full)
    used, held = summed.where("__full").agg(F.sum("__cap"), F.sum("__w")).first()
    left = (weight or 0.0) - (held or 0.0)
    level = (goal - (used or 0.0)) / left if left > 0 else 0.0
    return summed.select("__nosrc", "__src", "source_size",
                         F.when(F.col("__full"), F.col("__cap"))
                         .otherwise(F.least(F.col("__cap"), F.col("__w") * F.lit(level))).alias("target"))


def source_cuts(placed: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                most: float = 2.0, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per source: its size, target, whole epochs and the place and
    grant of the document at which the rest of its budget ends."""
    units = (placed.groupBy("__nosrc", "__src", *_PLACE)
             .agg(F.sum("size").alias("__words"), F.count("*").alias("__rows")))
    units = written(units, "units")
    n = units.count()
    bits = max(0, (max(1, n) // rows_per_range).bit_length())
    units = units.withColumn("__part", F.shiftright("__key", KEY_BITS - bits))
    ranges = units.groupBy("__nosrc", "__src", "__part").agg(F.sum("__words").alias("__words"))
    sizes = ranges.groupBy("__nosrc", "__src").agg(F.sum("__words").alias("source_size"))
    targets = written(source_targets(sizes, weights, share, most), "targets").withColumns({
        "__epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(F.lit(0)).cast("long")})
    targets = targets.withColumn("__rest", (F.floor("target") - F.col("__epochs") * F.col("source_size")).cast("long"))
    # summed in the order of all sources, so that no task holds all ranges of a source
    upto = written(running_sums(ranges, ["__nosrc", "__src", "__part"], {"__upto": "__words"})
                   .withColumn("__start", F.col("__upto") - F.col("__words")), "starts")
    first = upto.groupBy("__nosrc", "__src").agg(F.min("__start").alias("__first"))
    starts = (upto.join(targets.join(first, ["__nosrc", "__src"]), ["__nosrc", "__src"])
              .withColumn("__start", F.col("__start") - F.col("__first")))
    # only the range in which the budget ends is looked at row by row
    last = (starts.where((F.col("__start") < F.col("__rest"))
                         & (F.col("__start") + F.col("__words") >= F.col("__rest")))
            .select("__nosrc", "__src", "__part", "__start", "__rest"))
    w = (Window.partitionBy("__nosrc", "__src", "__part").orderBy(*_PLACE)
         .rowsBetween(Window.unboundedPreceding, -1))
    ends = (units.join(last, ["__nosrc", "__src", "__part"])
            .withColumn("__before", F.col("__start") + F.coalesce(F.sum("__words").over(w), F.lit(0)))
            .where("__before < __rest")
            .groupBy("__nosrc", "__src")
            .agg(F.max(F.struct(*_PLACE, F.floor((F.col("__rest") - F.col("__before")) / F.col("__rows"))
                                .cast("long").alias("grant"))).alias("__cut")))
    return targets.join(ends, ["__nosrc", "__src"], "left").drop("__rest")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        seed: int = 11, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size`` (words), its source's
    ``source_size`` and ``target``, and ``taken``: the words of the document
    that the mix takes, repeats counted (below ``size``: its first words).

    Sources sorted by code point, null last, weigh ``weights``, repeating; the
    mix has ``share`` times all words; no source is repeated more than ``most``
    times."""
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    placed = _placed(docs.select(*names), seed)
    slim = written(placed.select("__nosrc", "__src", *_PLACE, "size"), "sizes")
    cuts = written(source_cuts(slim, weights, share, most, rows_per_range), "cuts")
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    place = F.struct(*_PLACE)
    cut = F.struct(*[F.col(f"__cut.{c}") for c in _PLACE])
    rest = (F.when(F.col("__cut").isNull() | (place > cut), F.lit(0))
            .when(place < cut, F.col("size"))
            .otherwise(F.least(F.col("size"), F.col("__cut.grant"))))
    return (placed.join(cuts, ["__nosrc", "__src"])
            .withColumn("taken", (F.col("__epochs") * F.col("size") + rest).cast("long"))
            .select(*names, "size", "source_size", "target", "taken"))


def make_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per ``epoch`` (from 1) in which ``mix`` takes a
    document, with ``taken`` the words of that row.  The last epoch of the
    document at the cut has its granted first words as ``text``, and ``n_chars``,
    if there, counted again."""
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "epoch")]
    rows = (mix(docs.select(*names), **options).where("taken > 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
            .withColumn("taken", F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))))
    cut = F.col("taken") < F.col("size")
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(GAP_AND_WORD), F.lit(0)), F.lit(1),
                                 F.col("taken").cast("int")), "")
    rows = rows.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    return rows
