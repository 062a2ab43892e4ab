"""Lines with quoted fields, and records that don't fit kept apart.

``parse.parse_delimited`` splits at every separator and forgives short, long and
malformed lines.  Here a quoted field may hold the separator (``""`` is a quote
in it), and a line that has not exactly the declared fields, or a field that
isn't of its type, is marked with its whole text, so that it can be counted,
kept and repaired instead of becoming NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _schema(fields: Sequence[tuple[str, T.DataType]] | T.StructType) -> T.StructType:
    named = [(f.name, f.dataType) for f in fields.fields] if isinstance(fields, T.StructType) else list(fields)
    if CORRUPT in dict(named):
        raise ValueError(f"{CORRUPT} is reserved")
    return T.StructType([T.StructField(n, t) for n, t in named] + [T.StructField(CORRUPT, T.StringType())])


def _options(sep: str, **options) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
            "multiLine": "false", "columnPruning": "false"} | {k: str(v) for k, v in options.items()}


def parse_quoted(df: DataFrame, value_col: str, fields: Sequence[tuple[str, T.DataType]] | T.StructType,
                 sep: str = ",", keep: Sequence[str] = (), **options) -> DataFrame:
    """``keep`` columns, typed fields, and ``_corrupt``: the line's text if it
    has too few or too many fields or a field that isn't of its type (the
    fields that could be read are filled), else NULL.  A NULL line gives NULLs."""
    schema = _schema(fields)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    line = F.regexp_replace(F.col(value_col).cast("string"), r"[\r\n]+$", "")
    return (df.select(*[F.col(k) for k in keep], F.from_csv(line, ddl, _options(sep, **options)).alias("__row"))
            .select(*[F.col(k) for k in keep], *[F.col(f"__row.`{f.name}`").alias(f.name) for f in schema.fields]))


def read_quoted_csv(spark: SparkSession, path: str | list[str], fields: Sequence[tuple[str, T.DataType]] | T.StructType,
                    sep: str = ",", header: bool = False, **options) -> DataFrame:
    """CSV files as ``parse_quoted`` reads lines; with ``multiLine=True`` a quoted
    field may hold line ends (a file is then one task)."""
    df = spark.read.schema(_schema(fields)).option("header", header).options(**_options(sep, **options)).csv(path)
    # the reader checks only the fields that a query uses, and refuses to read the
    # mark alone: let the mark use them all, so that it is the same in every query
    nothing = F.substring(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns]), 1, 0)
    return df.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), F.concat(F.col(CORRUPT), nothing)))


def render_quoted(df: DataFrame, columns: Sequence[str], out_col: str = "value", sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """One line per row, as ``parse_quoted`` reads it: strings are quoted, a
    quote in them is doubled; NULL is an empty field."""
    def text(c: str) -> Column:
        value = F.col(c).cast("string")
        if isinstance(df.schema[c].dataType, T.StringType):
            value = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(value, F.lit(""))
    return df.select(*[F.col(k) for k in keep], F.concat_ws(sep, *[text(c) for c in columns]).alias(out_col))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """What was set apart: ``keep`` columns and the text."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(*keep, CORRUPT)


def split_corrupt(parsed: DataFrame, quarantine_path: str, mode: str = "append") -> DataFrame:
    """Write the corrupt lines as text under ``quarantine_path`` and return the
    good rows.  The input is read for each of the two."""
    corrupt_rows(parsed).write.mode(mode).text(quarantine_path)
    return good_rows(parsed)
