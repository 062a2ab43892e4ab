"""Schema-driven parsing of delimited text lines into typed columns.

Under ANSI mode a plain ``cast`` raises on bad input and ``getItem`` raises
out of range; ``try_cast`` and ``get`` return NULL, which is the behaviour a
log parser needs: short rows give NULL tails, malformed numbers give NULL,
extra fields are ignored.  A trailing newline or blank on a numeric field is
tolerated (the producer appends its bucket after the line's newline).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bytes_to_string(col: Column | str = "value") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def _field(parts: Column, i: int, name: str, dtype: T.DataType, trim_strings: bool) -> Column:
    raw = F.get(parts, i)
    if isinstance(dtype, T.StringType):
        val = F.regexp_replace(raw, r"^\s+|\s+$", "") if trim_strings else raw
        return val.alias(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raw = F.regexp_replace(raw, r"^\s+|\s+$", "")
    return raw.try_cast(dtype).alias(name)


def parse_delimited(df: DataFrame, value_col: str,
                    fields: Sequence[tuple[str, T.DataType]] | T.StructType,
                    sep: str = ",", keep: Sequence[str] = (),
                    trim_strings: bool = False) -> DataFrame:
    """Split ``value_col`` on the literal ``sep`` and project item i as field i.

    ``keep`` names input columns carried through unchanged.
    """
    if isinstance(fields, T.StructType):
        fields = [(f.name, f.dataType) for f in fields.fields]
    pattern = "\\Q" + sep + "\\E"
    # split once into an array column, then project the items from it
    split = df.select(*[F.col(k) for k in keep],
                      F.split(F.col(value_col).cast("string"), pattern).alias("__parts"))
    parts = F.col("__parts")
    cols = [F.col(k) for k in keep]
    cols += [_field(parts, i, n, t, trim_strings) for i, (n, t) in enumerate(fields)]
    return split.select(*cols)


def render_delimited(df: DataFrame, columns: Sequence[str], out_col: str = "value",
                     sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """One text line per row (NULL -> empty), as ``parse_delimited`` reads it.
    Like the surveyed producer it neither quotes nor escapes: a value that holds
    ``sep`` shifts the fields after it, so a field with free text goes last, or
    ``sep`` is one that no value holds."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(*[F.col(k) for k in keep], F.concat_ws(sep, *parts).alias(out_col))
