"""Label -> category lookup as a literal map (no Python UDF).

The map is a ``create_map`` literal of normalised labels, so the lookup is a
code-generated expression, filters on the category push through it, and no
join or shuffle is needed.  Large maps can instead be joined as a dimension
frame (``label_map_frame``) and Spark/AQE picks the broadcast by its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.text import normalize_label


def _pairs(mapping: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    seen: dict[str, str] = {}
    for category, labels in mapping.items():
        for label in labels:
            # first category listing a label wins, as a dict scan would
            seen.setdefault(label.strip().lower(), category)
    return list(seen.items())


def category_of(col: Column | str, mapping: Mapping[str, Sequence[str]],
                normalize: bool = True) -> Column:
    """Category of a label; unmapped or NULL label -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    key = normalize_label(c) if normalize else c
    kv = [F.lit(x) for pair in _pairs(mapping) for x in pair]
    return F.try_element_at(F.create_map(*kv), key)


def map_categories(df: DataFrame, label_col: str, mapping: Mapping[str, Sequence[str]],
                   out_col: str = "category", drop_unmapped: bool = True,
                   normalize: bool = True) -> DataFrame:
    """Add ``out_col``; by default rows whose label is unmapped (or NULL) are
    dropped, as the surveyed pipeline does."""
    out = df.withColumn(out_col, category_of(label_col, mapping, normalize))
    return out.where(F.col(out_col).isNotNull()) if drop_unmapped else out


def label_map_frame(spark: SparkSession, mapping: Mapping[str, Sequence[str]],
                    label_col: str = "label", category_col: str = "category") -> DataFrame:
    """The map as a two-column dimension frame (for very large maps)."""
    return spark.createDataFrame(_pairs(mapping), f"{label_col} string, {category_col} string")


def map_categories_join(df: DataFrame, label_col: str, label_map: DataFrame, out_col: str = "category",
                        drop_unmapped: bool = True, normalize: bool = True) -> DataFrame:
    """``map_categories`` for a map that is a table (label, category): an
    equi-join on the normalised label.  Labels of the map must be unique; AQE
    broadcasts a map that is small by its measured size."""
    label, category = label_map.columns[:2]
    key = normalize_label(F.col(label_col)) if normalize else F.col(label_col)
    side = label_map.select(F.col(label).alias("__label"), F.col(category).alias(out_col))
    out = df.drop(out_col).withColumn("__label", key).join(side, "__label", "inner" if drop_unmapped else "left")
    return out.select(*[c for c in df.columns if c != out_col], out_col)
