"""The connection-log ETL as one parameterised composition, with the three
generations of the surveyed code as presets.

    v1       dedup -> strip '.' (regexp) -> cap label -> map+drop unmapped -> rebalance
    v2       dedup -> drop column -> strip '.' (translate) -> cap label
             -> exclude rare labels -> map+drop unmapped -> rebalance
    explore  dedup -> strip '.' (regexp) -> map+drop unmapped -> cap label -> rebalance

Every step is a DataFrame transformation; the cleaned rows are written once
before the rebalance reads them three times.  Picks are deterministic: rows are ordered by ``order_by`` columns (by
default an md5 of the whole row, which is unique once duplicates are gone),
and relabelling draws from a seeded hash of the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.categorize import map_categories
from kestrel.functions.text import strip_chars
from kestrel.operators.dedup import drop_duplicates
from kestrel.operators.filters import exclude_values
from kestrel.operators.sampling import cap_value, rebalance
from kestrel.session import scratch_path
from kestrel.schemas import ATTACK_CATEGORIES, RARE_ATTACKS, RELABEL_TARGETS


@dataclass(frozen=True)
class EtlPreset:
    strip_method: str = "translate"
    drop_columns: tuple[str, ...] = ()
    cap_before_map: bool = True
    cap_label: str | None = "neptune"
    cap_keep: int = 20000
    rare_labels: tuple[str, ...] = ()
    mapping: Mapping[str, Sequence[str]] = field(default_factory=lambda: ATTACK_CATEGORIES)
    majority: str = "normal"
    relabel_n: int = 100000
    tail_n: int = 80000
    targets: tuple[str, ...] = tuple(RELABEL_TARGETS)
    tail_scope: str = "all"
    rebalance: bool = True


# The parameters of the three surveyed ETL generations.
PRESETS: dict[str, EtlPreset] = {
    "v1": EtlPreset(strip_method="regexp"),
    "v2": EtlPreset(strip_method="translate", drop_columns=("num_outbound_cmds",),
                    rare_labels=tuple(RARE_ATTACKS)),
    "explore": EtlPreset(strip_method="regexp", cap_before_map=False),
}


def row_hash(df: DataFrame, seed: int | str = 7) -> F.Column:
    """md5 over the whole row (NULL-safe), a practically unique order key."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))
                                  for c in df.columns]
    return F.md5(F.concat_ws("\u0001", *parts))


def prepare(df: DataFrame, preset: str | EtlPreset = "v2", label_col: str = "attack",
            category_col: str = "category", order_by: Sequence[str] | None = None,
            key_cols: Sequence[str] | None = None, seed: int = 7,
            salt_buckets: int | None = None, materialize: bool = True,
            **overrides) -> DataFrame:
    """Run the ETL preset (fields of ``EtlPreset`` can be overridden).

    ``materialize`` (default): the rebalance reads the cleaned, mapped rows
    three times (non-majority, head, tail), and each branch would otherwise
    repeat the dedup shuffle under its own pushed filter.  The cleaned rows are
    written once to the shared scratch area (they survive executor loss; see
    ``session.clear_scratch``), and the three branches scan that.  False keeps
    the whole chain one lazy plan.
    """
    p = PRESETS[preset] if isinstance(preset, str) else preset
    if overrides:
        p = replace(p, **overrides)
    out = drop_duplicates(df)
    if p.drop_columns:
        out = out.drop(*p.drop_columns)
    out = out.withColumn(label_col, strip_chars(label_col, ".", p.strip_method))
    own_key = order_by is None
    if own_key:
        # two 60-bit integers from the row's md5: the first drives the exact
        # histogram cutoff in first_n, the pair makes ties practically
        # impossible even at 1e11 rows (rows are unique after dedup)
        digest = row_hash(out, seed)
        out = out.withColumns({
            "__key": F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"),
            "__key2": F.conv(F.substring(digest, 16, 15), 16, 10).cast("bigint")})
        order_by = ["__key", "__key2"]
    key_cols = list(key_cols or order_by)

    def cap(frame: DataFrame) -> DataFrame:
        if p.cap_label is None:
            return frame
        return cap_value(frame, label_col, p.cap_label, p.cap_keep, order_by,
                         salt_buckets=salt_buckets)

    if p.cap_before_map:
        out = cap(out)
    if p.rare_labels:
        out = exclude_values(out, label_col, p.rare_labels)
    out = map_categories(out, label_col, p.mapping, out_col=category_col)
    if not p.cap_before_map:
        out = cap(out)
    if p.rebalance:
        if materialize:
            spark, schema, path = out.sparkSession, out.schema, scratch_path(out.sparkSession, "etl")
            out.write.parquet(path)
            out = spark.read.schema(schema).parquet(path)
        out = rebalance(out, category_col, p.majority, p.relabel_n, p.tail_n, p.targets,
                        order_by, key_cols, seed=seed, tail_scope=p.tail_scope,
                        salt_buckets=salt_buckets)
    return out.drop("__key", "__key2") if own_key else out
