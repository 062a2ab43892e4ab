"""Registered queries over the driver tables, each with an equivalent SQL text.

The driver's tables hold no connection log, and the operators are generic, so
each operator runs on a table with the same shape of problem (a label column
to clean, map, cap and rebalance; a prediction/label pair; a time column to
bucket).  Every query reads whole tables; limits appear only where they are
the operator (capping, head/tail samples, top-k).

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB
SQL over the same tables) produce the same rows with the same column names.
Models are trained where one feature decides the label, so that the SQL twin
states their predictions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.categorize import category_of, map_categories
from kestrel.functions.hashing import hash_key
from kestrel.functions.parse import bytes_to_string, parse_delimited, render_delimited
from kestrel.functions.text import strip_chars
from kestrel.functions.times import ntz_as_utc
from kestrel.operators.columns import (column_distinct_counts, column_profile,
                                       drop_constant_columns, table_shape)
from kestrel.operators.dedup import distinct_rows, distinct_values, drop_duplicates
from kestrel.operators.filters import drop_rare_values, exclude_equal, exclude_values
from kestrel.operators.latest import latest_only, latest_window
from kestrel.operators.metrics import binary_metrics
from kestrel.operators.ml import holdout_metrics, predict, string_index_table, train_model
from kestrel.operators.sampling import (cap_value, cap_values, hash_split, last_n, rebalance,
                                        relabel_first, random_split)
from kestrel.operators.stats import category_stats, value_counts
from kestrel.plans.etl import EtlPreset, prepare
from kestrel.plans.ledger import compare_pairs, top_stages, total_time
from kestrel.session import cached, read_table, scratch_path
from kestrel.streaming.rate import window_rate
from kestrel.streaming.sinks import read_current, run_append_by_batch, run_complete_overwrite
from kestrel.streaming.sources import parquet_table_stream, text_lines_stream

Query = Callable[[SparkSession, str], DataFrame]

# Query parameters on the driver tables.
EVENT_CATEGORIES = {"engagement": ["click", "view"], "conversion": ["purchase", "signup"]}
SEED = 7
CAP_LABEL, CAP_KEEP = "click", 50
TAIL_N = 300
RELABEL_N = 500
RELABEL_TARGETS = ["purchase", "signup", "view"]
POSITIVE_THRESHOLD = 50.0
RARE_SHARE = 0.04
ETL_TARGETS = ("conversion", "retention", "support")

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- SQL helpers

def sql_hash(seed: str | int, expr: str) -> str:
    """SQL twin of ``hash_key(seed, expr)``."""
    return f"CAST(('0x' || substr(md5('{seed}|' || CAST({expr} AS VARCHAR)), 1, 15)) AS BIGINT)"


def sql_pick(seed: str, choices, expr: str) -> str:
    h = sql_hash(seed, expr)
    whens = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(choices[:-1]))
    return f"CASE {h} % {len(choices)} {whens} ELSE '{choices[-1]}' END"


def sql_category(expr: str, mapping=EVENT_CATEGORIES) -> str:
    norm = f"lower(regexp_replace({expr}, '^\\s+|\\s+$', '', 'g'))"
    whens = " ".join(f"WHEN '{lbl}' THEN '{cat}'" for cat, lbls in mapping.items() for lbl in lbls)
    return f"CASE {norm} {whens} END"


H_EVENT = sql_hash(SEED, "event_id")
TRAIN_EDGE = 3 << 58          # 0.75 of the 60-bit key space
PICK_SEED = f"{SEED}:pick"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _with_h(df: DataFrame) -> DataFrame:
    return df.withColumn("__h", hash_key(SEED, "event_id"))


# ------------------------------------------------- flagship: counts per category

@register("category_counts", f"""
SELECT category, count(category) AS counts
FROM (SELECT {sql_category('event_type')} AS category FROM (SELECT DISTINCT * FROM events) d) m
WHERE category IS NOT NULL
GROUP BY category
""")
def category_counts(spark, sf_dir):
    """dedup -> normalise + map label -> drop unmapped -> count per category."""
    ev = drop_duplicates(_events(spark, sf_dir))
    mapped = map_categories(ev, "event_type", EVENT_CATEGORIES)
    return mapped.groupBy("category").agg(F.count("category").alias("counts"))


@register("category_counts_sql", f"""
SELECT category, count(category) AS counts
FROM (SELECT {sql_category('event_type')} AS category FROM (SELECT DISTINCT * FROM events) d) m
WHERE category IS NOT NULL AND category != 'other'
GROUP BY category
""")
def category_counts_sql(spark, sf_dir):
    """The flagship's final count as the SQL statement the surveyed runbook
    gives, run with ``spark.sql`` over a DataFrame reference (no global view
    name) and a bound parameter (no value formatted into the SQL text).
    Catalyst plans it exactly like the DataFrame form."""
    ev = drop_duplicates(_events(spark, sf_dir))
    mapped = map_categories(ev, "event_type", EVENT_CATEGORIES)
    return spark.sql(
        "SELECT category, count(category) AS counts FROM {m} "
        "WHERE category IS NOT NULL AND category != :skip GROUP BY category",
        args={"skip": "other"}, m=mapped)


# ------------------------------------------------------------- value counts

_NULLED_FLAG = "(SELECT nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem) t"


def _nulled_flags(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"))


@register("value_counts_nonnull", f"""
SELECT l_returnflag, count(l_returnflag) AS n FROM {_NULLED_FLAG} GROUP BY l_returnflag
""")
def value_counts_nonnull(spark, sf_dir):
    return value_counts(_nulled_flags(spark, sf_dir), "l_returnflag", count_rows=False)


@register("value_counts_rows", f"""
SELECT l_returnflag, count(*) AS n FROM {_NULLED_FLAG} GROUP BY l_returnflag
""")
def value_counts_rows(spark, sf_dir):
    return value_counts(_nulled_flags(spark, sf_dir), "l_returnflag", count_rows=True)


# ------------------------------------------------------- per-category stats

_MAPPED_EVENTS = f"(SELECT *, {sql_category('event_type')} AS category FROM events) m WHERE category IS NOT NULL"


def _category_stats(spark, sf_dir):
    mapped = map_categories(_events(spark, sf_dir), "event_type", EVENT_CATEGORIES)
    return category_stats(mapped, "category", "value", positive_threshold=POSITIVE_THRESHOLD)


@register("avg_by_category", f"""
SELECT category, round(avg(value), 6) AS avg_value FROM {_MAPPED_EVENTS} GROUP BY category
""")
def avg_by_category(spark, sf_dir):
    return _category_stats(spark, sf_dir).select("category", "avg_value")


@register("attempts_by_category", f"""
SELECT category, count(value) AS nonnull_value FROM {_MAPPED_EVENTS} GROUP BY category
""")
def attempts_by_category(spark, sf_dir):
    return _category_stats(spark, sf_dir).select("category", "nonnull_value")


@register("positive_by_category", f"""
SELECT category, count_if(value > {POSITIVE_THRESHOLD}) AS positive_value
FROM {_MAPPED_EVENTS} GROUP BY category
""")
def positive_by_category(spark, sf_dir):
    return _category_stats(spark, sf_dir).select("category", "positive_value")


@register("table_shape", "SELECT count(*) AS n_rows, 6 AS n_cols FROM orders")
def table_shape_q(spark, sf_dir):
    return table_shape(read_table(spark, sf_dir, "orders"))


# ------------------------------------------------------------------ distinct

@register("distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem
""")
def distinct_rows_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return distinct_rows(li, ["l_returnflag", "l_linestatus", "l_quantity"])


@register("distinct_values", "SELECT DISTINCT l_returnflag FROM lineitem")
def distinct_values_q(spark, sf_dir):
    return distinct_values(read_table(spark, sf_dir, "lineitem"), "l_returnflag")


@register("dedup_rows", """
SELECT DISTINCT o_orderstatus, o_orderpriority, o_custkey FROM orders
""")
def dedup_rows_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", "o_custkey")
    return drop_duplicates(o)


# ------------------------------------------------------- constant columns

_F_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                  "o_orderpriority", "o_kind", "o_flag", "o_none"]
_F_ORDERS_SQL = """(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    o_orderpriority,
    CASE WHEN o_orderkey IS NOT NULL THEN 'order' ELSE 'none' END AS o_kind,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'calm' END AS o_flag,
    CAST(NULL AS VARCHAR) AS o_none
  FROM orders)"""


def _f_orders(spark, sf_dir):
    """All orders, with a column of one value, one of a value and NULL, and one
    of NULL alone."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.when(F.col("o_orderkey").isNotNull(), F.lit("order")).otherwise(F.lit("none")).alias("o_kind"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
         .otherwise(F.lit("calm")).alias("o_flag"),
        F.lit(None).cast("string").alias("o_none"))


def _profile_sql() -> str:
    parts = []
    for c in _F_ORDERS_COLS:
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_nonnull, "
            f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) = 1 AS is_constant, "
            f"count(DISTINCT {c}) <= 1 AS is_constant_ignoring_null FROM f")
    return f"WITH f AS {_F_ORDERS_SQL}\n" + "\nUNION ALL\n".join(parts)


def _distinct_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + "
             f"max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM f"
             for c in _F_ORDERS_COLS]
    return f"WITH f AS {_F_ORDERS_SQL}\n" + "\nUNION ALL\n".join(parts)


@register("column_profile", _profile_sql())
def column_profile_q(spark, sf_dir):
    return column_profile(_f_orders(spark, sf_dir))


@register("column_distinct_counts", _distinct_sql())
def column_distinct_counts_q(spark, sf_dir):
    return column_distinct_counts(_f_orders(spark, sf_dir), null_is_value=True)


@register("distinct_counts_sketch", """
SELECT column_name, (SELECT count(*) FROM events) AS n_rows, true AS within_3_percent
FROM (VALUES ('event_id'), ('user_id'), ('event_type'), ('value'), ('props')) v(column_name)
""")
def distinct_counts_sketch_q(spark, sf_dir):
    """Sketches per day, stored in two runs and merged, against exact counts."""
    from kestrel.operators.sketches import merged_counts, store_slices
    from kestrel.sources.manifest import ManifestTable
    columns = ["event_id", "user_id", "event_type", "value", "props"]
    ev = _events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    table = ManifestTable(spark, scratch_path(spark, "sketches"), buckets=4)
    for run in ("dayofmonth(day) <= 20", "dayofmonth(day) > 20"):
        store_slices(table, ev.where(run), "day", columns, run)
    exact = column_distinct_counts(ev, columns).select("column_name", F.col("n_distinct").alias("n"))
    near = F.abs(F.col("n_distinct") - F.col("n")) <= 0.03 * F.col("n")
    return merged_counts(table.read()).join(exact, "column_name").select("column_name", "n_rows", near.alias("within_3_percent"))


@register("drop_constant_columns", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_flag FROM {_F_ORDERS_SQL} f
""")
def drop_constant_columns_q(spark, sf_dir):
    return drop_constant_columns(_f_orders(spark, sf_dir), null_is_value=True)


@register("drop_constant_columns_ignoring_null", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM {_F_ORDERS_SQL} f
""")
def drop_constant_columns_ignoring_null_q(spark, sf_dir):
    return drop_constant_columns(_f_orders(spark, sf_dir), null_is_value=False)


# ---------------------------------------------------------- string cleaning

@register("strip_chars_translate", "SELECT p_partkey, translate(p_brand, '#', '') AS p_brand FROM part")
def strip_chars_translate(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", strip_chars("p_brand", "#", "translate").alias("p_brand"))


@register("strip_chars_regexp", "SELECT p_partkey, regexp_replace(p_brand, '#', '', 'g') AS p_brand FROM part")
def strip_chars_regexp(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", strip_chars("p_brand", "#", "regexp").alias("p_brand"))


# ------------------------------------------------------------------ filters

@register("exclude_equal", """
SELECT event_id, event_type, value FROM events WHERE event_type != 'error'
""")
def exclude_equal_q(spark, sf_dir):
    return exclude_equal(_events(spark, sf_dir), "event_type", "error").select(
        "event_id", "event_type", "value")


@register("exclude_values", """
SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'signup')
""")
def exclude_values_q(spark, sf_dir):
    return exclude_values(_events(spark, sf_dir), "event_type", ["error", "signup"]).select(
        "event_id", "event_type", "value")


@register("drop_rare_values", f"""
WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
rare AS (SELECT p_brand FROM c WHERE p_brand IS NOT NULL AND n < {RARE_SHARE} * (SELECT count(*) FROM part))
SELECT p_partkey, p_brand FROM part
WHERE p_brand IS NOT NULL AND p_brand NOT IN (SELECT p_brand FROM rare)
""")
def drop_rare_values_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return drop_rare_values(p, "p_brand", min_share=RARE_SHARE)


# ------------------------------------------------------- capping / sampling

@register("cap_value", f"""
SELECT event_id, event_type, value FROM events WHERE event_type != '{CAP_LABEL}'
UNION ALL
SELECT event_id, event_type, value FROM (
  SELECT event_id, event_type, value FROM events WHERE event_type = '{CAP_LABEL}'
  ORDER BY {H_EVENT}, event_id LIMIT {CAP_KEEP}) c
""")
def cap_value_q(spark, sf_dir):
    ev = _with_h(_events(spark, sf_dir).select("event_id", "event_type", "value"))
    return cap_value(ev, "event_type", CAP_LABEL, CAP_KEEP, ["__h", "event_id"]).drop("__h")


@register("cap_all_values", f"""
SELECT event_id, event_type FROM (
  SELECT event_id, event_type,
         row_number() OVER (PARTITION BY event_type ORDER BY {H_EVENT}, event_id) AS rn
  FROM events) t
WHERE rn <= {CAP_KEEP}
""")
def cap_all_values_q(spark, sf_dir):
    ev = _with_h(_events(spark, sf_dir).select("event_id", "event_type"))
    return cap_values(ev, "event_type", CAP_KEEP, ["__h", "event_id"]).drop("__h")


@register("tail_sample", f"""
SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT {TAIL_N}
""")
def tail_sample_q(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "event_type")
    return last_n(ev, TAIL_N, ["event_id"])


@register("tail_by_position", f"""
SELECT event_id, event_id AS position, event_type, value FROM events ORDER BY event_id DESC LIMIT {TAIL_N}
""")
def tail_by_position_q(spark, sf_dir):
    """The last rows by their place in the file (the events' ids count them)."""
    from kestrel.operators.position import tail_by_position
    rows = tail_by_position(read_table(spark, sf_dir, "events"), TAIL_N)
    return rows.select("event_id", "position", "event_type", "value")


@register("relabel_majority", f"""
SELECT event_id, {sql_pick(PICK_SEED, RELABEL_TARGETS, 'event_id')} AS event_type FROM (
  SELECT event_id FROM events WHERE event_type = '{CAP_LABEL}'
  ORDER BY {H_EVENT}, event_id LIMIT {RELABEL_N}) h
""")
def relabel_majority_q(spark, sf_dir):
    ev = _with_h(_events(spark, sf_dir).select("event_id", "event_type"))
    out = relabel_first(ev, "event_type", CAP_LABEL, RELABEL_N, RELABEL_TARGETS,
                        ["__h", "event_id"], ["event_id"], seed=SEED)
    return out.select("event_id", "event_type")


def _rebalance_sql(scope: str) -> str:
    base = f"(SELECT event_id, event_type, {H_EVENT} AS h FROM events)"
    head = (f"SELECT event_id, h FROM {base} b WHERE event_type = '{CAP_LABEL}' "
            f"ORDER BY h, event_id LIMIT {RELABEL_N}")
    if scope == "all":
        tail = f"SELECT event_id, event_type FROM {base} b ORDER BY h DESC, event_id DESC LIMIT {TAIL_N}"
    else:
        tail = (f"SELECT event_id, event_type FROM (SELECT event_id, event_type, h, "
                f"row_number() OVER (ORDER BY h, event_id) AS rn FROM {base} b "
                f"WHERE event_type = '{CAP_LABEL}') r WHERE rn > {RELABEL_N} "
                f"ORDER BY h DESC, event_id DESC LIMIT {TAIL_N}")
    return f"""
SELECT event_id, event_type FROM events WHERE event_type != '{CAP_LABEL}'
UNION ALL
SELECT event_id, {sql_pick(PICK_SEED, RELABEL_TARGETS, 'event_id')} AS event_type FROM ({head}) hd
UNION ALL
SELECT event_id, event_type FROM ({tail}) tl
"""


def _rebalance(spark, sf_dir, scope):
    ev = _with_h(_events(spark, sf_dir).select("event_id", "event_type"))
    out = rebalance(ev, "event_type", CAP_LABEL, RELABEL_N, TAIL_N, RELABEL_TARGETS,
                    ["__h", "event_id"], ["event_id"], seed=SEED, tail_scope=scope)
    return out.select("event_id", "event_type")


@register("rebalance_all", _rebalance_sql("all"))
def rebalance_all_q(spark, sf_dir):
    return _rebalance(spark, sf_dir, "all")


@register("rebalance_rest", _rebalance_sql("majority_rest"))
def rebalance_rest_q(spark, sf_dir):
    return _rebalance(spark, sf_dir, "majority_rest")


@register("hash_split", f"""
SELECT event_id, CASE WHEN {H_EVENT} < {TRAIN_EDGE} THEN 'train' ELSE 'validation' END AS split
FROM events
""")
def hash_split_q(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id")
    return hash_split(ev, [0.75, 0.25], ["event_id"], seed=SEED, names=["train", "validation"])


@register("random_split_sizes", """
SELECT count(*) AS n_both, true AS train_is_larger FROM events
""")
def random_split_sizes_q(spark, sf_dir):
    """The two sides hold every row once, about three quarters in the first
    (which rows, depends on the partitioning)."""
    ev = _events(spark, sf_dir).select("event_id")
    train, valid = random_split(ev, [0.75, 0.25], seed=SEED)
    n_train = F.count_if(F.col("split") == "train")
    return (train.select(F.lit("train").alias("split"))
            .unionByName(valid.select(F.lit("validation").alias("split")))
            .agg(F.count(F.lit(1)).alias("n_both"), (n_train * 2 > F.count(F.lit(1))).alias("train_is_larger")))


# ------------------------------------------------------------- line parsing

_EVENT_FIELDS = [("event_id", T.LongType()), ("ts", T.TimestampNTZType()),
                 ("user_id", T.LongType()), ("event_type", T.StringType()),
                 ("value", T.DoubleType()), ("props", T.StringType())]
_SEP = "\t"       # occurs in no value


@register("parse_lines", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def parse_lines_q(spark, sf_dir):
    """Lines as a message queue gives them, i.e. bytes."""
    ev = _events(spark, sf_dir)
    lines = render_delimited(ev, [n for n, _ in _EVENT_FIELDS], sep=_SEP)
    raw = lines.select(F.col("value").cast("binary").alias("value"))
    return parse_delimited(raw.withColumn("value", bytes_to_string("value")), "value", _EVENT_FIELDS, sep=_SEP)


@register("parse_lines_malformed", """
SELECT event_id, ts, user_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' THEN props || chr(10)
            ELSE props END AS props
FROM events
""")
def parse_lines_malformed_q(spark, sf_dir):
    """Short lines (error events cut after 3 fields) give NULL tails; a line
    that ends in a newline (purchase events) still parses."""
    ev = _events(spark, sf_dir)
    full = render_delimited(ev, [n for n, _ in _EVENT_FIELDS], keep=["event_type"], sep=_SEP)
    short = F.array_join(F.slice(F.split(F.col("value"), _SEP), 1, 3), _SEP)
    lines = full.select(
        F.when(F.col("event_type") == "error", short)
         .when(F.col("event_type") == "purchase", F.concat(F.col("value"), F.lit("\n")))
         .otherwise(F.col("value")).alias("value"))
    return parse_delimited(lines, "value", _EVENT_FIELDS, sep=_SEP)


# ------------------------------------------------------------------ metrics

_QUOTED_FIELDS = [("event_id", T.LongType()), ("value", T.DoubleType()), ("note", T.StringType())]


def _quoted_lines(spark, sf_dir):
    """Quoted lines whose last field holds separators and quotes; of every ten,
    one is cut short, one has a bad number and one a field too many."""
    from kestrel.functions.quoted import render_quoted
    ev = _events(spark, sf_dir).withColumn("note", F.concat("event_type", F.lit(", said \""), "props", F.lit("\"")))
    lines = render_quoted(ev, ["event_id", "value", "note"], keep=["event_id"])
    kind, text = F.col("event_id") % 10, F.col("value")
    return lines.select(F.when(kind == 3, F.regexp_replace(text, "^([^,]*,[^,]*),.*$", "$1"))
                        .when(kind == 4, F.regexp_replace(text, "^([^,]*),[^,]*", "$1,none"))
                        .when(kind == 5, F.concat(text, F.lit(",more"))).otherwise(text).alias("line"))


_QUOTED_SQL = """
SELECT event_id, CASE WHEN event_id % 10 <> 4 THEN value END AS value,
       CASE WHEN event_id % 10 <> 3 THEN event_type || ', said "' || props || '"' END AS note,
       event_id % 10 IN (3, 4, 5) AS is_corrupt
FROM events
"""


@register("parse_quoted_lines", _QUOTED_SQL)
def parse_quoted_lines_q(spark, sf_dir):
    from kestrel.functions.quoted import CORRUPT, parse_quoted
    parsed = parse_quoted(_quoted_lines(spark, sf_dir), "line", _QUOTED_FIELDS)
    return parsed.withColumn("is_corrupt", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


@register("csv_malformed_scan", f"""
SELECT event_id, CASE WHEN NOT is_corrupt THEN value END AS value, CASE WHEN NOT is_corrupt THEN note END AS note, is_corrupt
FROM ({_QUOTED_SQL}) q
""")
def csv_malformed_scan_q(spark, sf_dir):
    """The same lines as files: good rows typed, the others set apart as text
    (of which the id is read back)."""
    from kestrel.functions.quoted import read_quoted_csv, split_corrupt
    path, bad = scratch_path(spark, "quoted-lines"), scratch_path(spark, "quarantine")
    _quoted_lines(spark, sf_dir).write.text(path)
    good = split_corrupt(read_quoted_csv(spark, path, _QUOTED_FIELDS), bad)
    apart = spark.read.text(bad).select(F.substring_index("value", ",", 1).cast("long").alias("event_id"),
                                        F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("note"))
    return good.withColumn("is_corrupt", F.lit(False)).unionByName(apart.withColumn("is_corrupt", F.lit(True)))


@register("binary_metrics", """
WITH c AS (
  SELECT count_if(quality != 0 AND toxic != 0) AS tp,
         count_if(quality != 0 AND toxic = 0) AS fp,
         count_if(quality = 0 AND toxic = 0) AS tn,
         count_if(quality = 0 AND toxic != 0) AS fn
  FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL)
SELECT tp, fp, tn, fn,
  CASE WHEN fp + tn > 0 THEN round(fp / (fp + tn), 6) END AS false_positive_rate,
  CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall,
  CASE WHEN tp + fp + tn + fn > 0 THEN round((tp + tn) / (tp + fp + tn + fn), 6) END AS accuracy
FROM c
""")
def binary_metrics_q(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels")
    return binary_metrics(lab, "quality", "toxic", negative=0)


@register("string_index", """
SELECT event_type, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS idx
FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""")
def string_index_q(spark, sf_dir):
    return string_index_table(_events(spark, sf_dir), "event_type")


# ------------------------------------------------------------ rates / windows

def _rate_sql(seconds: int) -> str:
    return (f"SELECT time_bucket(INTERVAL {seconds} SECOND, ts) AS window_start, count(ts) AS rate "
            f"FROM events GROUP BY 1")


@register("rate_10s_batch", _rate_sql(10))
def rate_10s_batch(spark, sf_dir):
    return window_rate(_events(spark, sf_dir), "ts", "10 seconds")


@register("rate_1h_batch", _rate_sql(3600))
def rate_1h_batch(spark, sf_dir):
    return window_rate(_events(spark, sf_dir), "ts", "1 hour")


def _rate_stream(spark, sf_dir, duration):
    from kestrel.session import table_path
    src = parquet_table_stream(spark, table_path(sf_dir, "events"))
    agg = window_rate(src, "ts", duration)
    out = scratch_path(spark, "rate-out")
    run_complete_overwrite(agg, out, scratch_path(spark, "rate-ckpt"))
    return read_current(spark, out)


@register("rate_10s_stream", _rate_sql(10))
def rate_10s_stream(spark, sf_dir):
    return _rate_stream(spark, sf_dir, "10 seconds")


@register("rate_1h_stream", _rate_sql(3600))
def rate_1h_stream(spark, sf_dir):
    return _rate_stream(spark, sf_dir, "1 hour")


@register("rate_10s_stream_append", f"""
WITH r AS ({_rate_sql(10)})
SELECT window_start, rate FROM r WHERE window_start < (SELECT max(window_start) FROM r)
""")
def rate_10s_stream_append(spark, sf_dir):
    """The rate as it should run on an endless stream: a watermark (no
    allowed lateness here) lets Append mode emit each window once it closes
    and drop its state, so state stays bounded by the open windows.  At the
    end of the input the window holding the latest event is still open and
    is not emitted; every other window is, exactly once (the sink is
    idempotent by batch id)."""
    from kestrel.session import table_path
    src = parquet_table_stream(spark, table_path(sf_dir, "events"))
    agg = window_rate(src, "ts", "10 seconds", watermark="0 seconds")
    out = scratch_path(spark, "rate-append-out")
    run_append_by_batch(agg, out, scratch_path(spark, "rate-append-ckpt"))
    return spark.read.parquet(out).drop("batch_id")


@register("latest_bucket", f"""
WITH r AS ({_rate_sql(3600)})
SELECT window_start, rate FROM r WHERE window_start = (SELECT max(window_start) FROM r)
""")
def latest_bucket_q(spark, sf_dir):
    return window_rate(latest_window(_events(spark, sf_dir), "ts", "1 hour"), "ts", "1 hour")


# ------------------------------------------------------------ CSV round trip

@register("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip_q(spark, sf_dir):
    """orders -> headerless gzip CSV in the shared scratch area -> declared-schema read."""
    from kestrel.sources.files import read_csv, write_csv
    o = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    write_csv(o, path, compression="gzip", timestampNTZFormat=fmt)
    return read_csv(spark, path, o.schema, repartition=4, timestampNTZFormat=fmt)


# ---------------------------------------------------------------- ML
# Among noise features one binary feature decides the label, so the predictions of
# a forest that learned it are known by value, whatever the partitions.

def _ml_features(ev, label="category"):
    return ev.select("event_id", "user_id", "value", F.col("category").alias(label),
                     F.hour("ts").alias("hour"), F.dayofweek("ts").alias("dow"),
                     F.col("event_type").isin(EVENT_CATEGORIES["conversion"]).cast("int").alias("paid"))


def _ml_events(spark, sf_dir):
    return _ml_features(map_categories(_events(spark, sf_dir), "event_type", EVENT_CATEGORIES))


_SCORED_SQL = f"""
SELECT event_id, truth, CASE WHEN event_type IN ('purchase', 'signup') THEN 'conversion' ELSE 'engagement' END AS predicted
FROM (SELECT event_id, event_type, {sql_category('event_type')} AS truth FROM events) t WHERE truth IS NOT NULL
"""


def _scored(df):
    return df.select("event_id", "truth", "predicted")


@register("rf_train_score", _SCORED_SQL)
def rf_train_score_q(spark, sf_dir):
    ev = _ml_events(spark, sf_dir)
    model = train_model(ev, label_col="category", exclude=["event_id"])
    return _scored(predict(model, ev.withColumnRenamed("category", "truth"), out_col="predicted"))


@register("rf_holdout_metrics", f"""
SELECT count_if(category != 'engagement') AS tp, 0::BIGINT AS fp, count_if(category = 'engagement') AS tn, 0::BIGINT AS fn,
       1.0 AS precision, 1.0 AS recall, 1.0 AS accuracy, 0.0 AS false_positive_rate
FROM (SELECT event_id, {sql_category('event_type')} AS category FROM events) t
WHERE category IS NOT NULL AND {H_EVENT} >= {TRAIN_EDGE}
""")
def rf_holdout_metrics_q(spark, sf_dir):
    """Split by a hash of the id, fit, score the held-out side."""
    ev = _ml_events(spark, sf_dir)
    return holdout_metrics(ev, label_col="category", negative="engagement", exclude=["event_id"],
                           seed=SEED, split_keys=["event_id"])


def _score_to_table(spark, model, rows, name):
    out = scratch_path(spark, f"{name}-out")
    run_append_by_batch(predict(model, rows, out_col="predicted"), out, scratch_path(spark, f"{name}-ckpt"))
    return _scored(spark.read.parquet(out))


@register("rf_stream_score", _SCORED_SQL)
def rf_stream_score_q(spark, sf_dir):
    """Fit on the batch table, then score the same table read as a stream,
    appended per micro-batch (idempotent by batch id) and read back."""
    from kestrel.session import table_path
    model = train_model(_ml_events(spark, sf_dir), label_col="category", exclude=["event_id"])
    src = parquet_table_stream(spark, table_path(sf_dir, "events"))
    rows = _ml_features(map_categories(src, "event_type", EVENT_CATEGORIES), "truth")
    return _score_to_table(spark, model, rows, "score")


@register("rf_stream_parse_score", _SCORED_SQL)
def rf_stream_parse_score_q(spark, sf_dir):
    """Stream scoring from end to end: text lines -> typed columns -> label map
    -> model -> sink."""
    model = train_model(_ml_events(spark, sf_dir), label_col="category", exclude=["event_id"])
    path = scratch_path(spark, "lines")
    render_delimited(_events(spark, sf_dir), [n for n, _ in _EVENT_FIELDS], sep=_SEP).write.text(path)
    events = parse_delimited(text_lines_stream(spark, path), "value", _EVENT_FIELDS, sep=_SEP)
    rows = _ml_features(map_categories(events, "event_type", EVENT_CATEGORIES), "truth")
    return _score_to_table(spark, model, rows, "parse-score")


@register("string_encode_rows", """
WITH d AS (SELECT CAST(o_custkey AS VARCHAR) AS k, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS idx
           FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1)
SELECT c_custkey, CAST(coalesce(idx, (SELECT count(*) FROM d)) AS DOUBLE) AS c_custkey_index
FROM customer LEFT JOIN d ON k = CAST(c_custkey AS VARCHAR)
""")
def string_encode_rows_q(spark, sf_dir):
    """Customers numbered by how many orders they have; the dictionary is a
    table, customers without orders get the reserved index.  The commonest 256
    keys are broadcast, the others shuffled."""
    from kestrel.operators.encode import encode_rows, fit_dictionaries
    keys = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    known = fit_dictionaries(keys, ["c_custkey"], scratch_path(spark, "dictionary"))
    return encode_rows(read_table(spark, sf_dir, "customer").select("c_custkey"), known, hot_rows=256)


@register("rf_encoded_train_score", f"""
SELECT event_id, {sql_category('event_type')} AS predicted FROM events WHERE {sql_category('event_type')} IS NOT NULL
""")
def rf_encoded_train_score_q(spark, sf_dir):
    """Forest over a dictionary-encoded categorical column, saved with its
    dictionary, loaded and scored; the event type decides the category."""
    from kestrel.operators.encode import load_encoded, train_encoded
    ev = map_categories(_events(spark, sf_dir), "event_type", EVENT_CATEGORIES).select("event_id", "event_type", "value", "category")
    path = scratch_path(spark, "encoded-model")
    train_encoded(ev, path, ["event_type"], exclude=["event_id"])
    return load_encoded(spark, path).predict(ev.drop("category"), out_col="predicted").select("event_id", "predicted")


# -------------------------------------------------------------------- ledger

_LEDGER_SQL = """(SELECT event_type AS file_name, 'user_' || CAST(user_id AS VARCHAR) AS function_name,
   'event ' || CAST(event_id AS VARCHAR) AS description, value AS time_taken FROM events)"""


def _ledger_lines(spark, sf_dir):
    """events rendered as ledger text lines (' file, function, desc, secs ',
    with the blanks of the real ledger file)."""
    ev = _events(spark, sf_dir)
    return ev.select(F.concat_ws(
        ", ", F.concat(F.lit(" "), F.col("event_type")),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")),
        F.concat(F.lit("event "), F.col("event_id").cast("string")),
        F.concat(F.col("value").cast("string"), F.lit(" "))).alias("value"))


def _ledger(spark, sf_dir):
    """The ledger lines parsed back in place (one split per line)."""
    from kestrel.schemas import LEDGER_FIELDS
    return parse_delimited(_ledger_lines(spark, sf_dir), "value", LEDGER_FIELDS,
                           trim_strings=True)


@register("ledger_csv_scan", f"SELECT * FROM {_LEDGER_SQL} l")
def ledger_csv_scan(spark, sf_dir):
    """The ledger lines written as a text file in the shared scratch area and
    read back with the ledger CSV reader (declared schema, blanks trimmed)."""
    from kestrel.sources.files import read_ledger_csv
    path = scratch_path(spark, "ledger-csv")
    _ledger_lines(spark, sf_dir).write.mode("overwrite").text(path)
    return read_ledger_csv(spark, path)


@register("ledger_top_stage", f"""
SELECT * FROM {_LEDGER_SQL} l WHERE file_name != 'error'
ORDER BY time_taken DESC, file_name DESC, function_name DESC, description DESC LIMIT 3
""")
def ledger_top_stage(spark, sf_dir):
    return top_stages(_ledger(spark, sf_dir), n=3, exclude_file="error")


@register("ledger_total", f"""
SELECT round(sum(time_taken), 6) AS total_time, count(*) AS n_stages
FROM {_LEDGER_SQL} l WHERE file_name != 'error'
""")
def ledger_total(spark, sf_dir):
    return total_time(_ledger(spark, sf_dir), exclude_file="error")


@register("ledger_append_read", f"""
SELECT file_name, function_name, description, time_taken FROM {_LEDGER_SQL} l
UNION ALL SELECT 'job', 'load', 'first', CAST(NULL AS DOUBLE) UNION ALL SELECT 'job', 'score', 'second', CAST(NULL AS DOUBLE)
""")
def ledger_append_read_q(spark, sf_dir):
    """A ledger table that two stages of a running job are appended to, read
    back; the measured times of the two are left out."""
    from kestrel.plans.ledger import Ledger
    path, ledger = scratch_path(spark, "ledger"), Ledger()
    _ledger(spark, sf_dir).write.parquet(path)
    for function, description in (("load", "first"), ("score", "second")):
        with ledger.stage("job", function, description):
            pass
    ledger.append_to(spark, path)
    known = (F.col("file_name") != "job") | (F.col("time_taken") < 0)
    return spark.read.parquet(path).withColumn("time_taken", F.when(known, F.col("time_taken")))


_PAIRS = [("user_1", "user_2"), ("user_3", "user_4")]


@register("ledger_compare_pairs", "WITH l AS " + _LEDGER_SQL + """,
p AS (SELECT * FROM (VALUES ('user_1', 'user_2'), ('user_3', 'user_4')) v(method_a, method_b)),
t AS (SELECT p.method_a, p.method_b,
        (SELECT sum(time_taken) FROM l WHERE function_name = p.method_a) AS time_a,
        (SELECT sum(time_taken) FROM l WHERE function_name = p.method_b) AS time_b FROM p)
SELECT method_a, method_b, round(time_a, 6) AS time_a, round(time_b, 6) AS time_b,
       round(time_a / time_b, 6) AS ratio FROM t
""")
def ledger_compare_pairs(spark, sf_dir):
    return compare_pairs(_ledger(spark, sf_dir), _PAIRS)


# ------------------------------------------------------------- ETL presets

def _event_preset(gen: str) -> EtlPreset:
    common = dict(cap_label="view", cap_keep=800, mapping=EVENT_CATEGORIES,
                  majority="engagement", relabel_n=1000, tail_n=500, targets=ETL_TARGETS)
    if gen == "v1":
        return EtlPreset(strip_method="regexp", **common)
    if gen == "v2":
        return EtlPreset(strip_method="translate", drop_columns=("props",),
                         rare_labels=("signup",), **common)
    return EtlPreset(strip_method="regexp", cap_before_map=False, **common)


def _etl(spark, sf_dir, gen):
    ev = _with_h(_events(spark, sf_dir))
    out = prepare(ev, _event_preset(gen), label_col="event_type", order_by=["__h", "event_id"],
                  key_cols=["event_id"], seed=SEED)
    return out.select("event_id", "event_type", "category", "value")


def _etl_sql(gen: str) -> str:
    strip = ("regexp_replace(event_type, '\\.', '', 'g')" if gen != "v2"
             else "translate(event_type, '.', '')")
    cols = "event_id, ts, user_id, event_type, value" + ("" if gen == "v2" else ", props")
    cap = lambda src: (f"SELECT * FROM {src} WHERE event_type != 'view' UNION ALL "
                       f"SELECT * FROM (SELECT * FROM {src} WHERE event_type = 'view' "
                       f"ORDER BY h, event_id LIMIT 800) cv")
    steps = [
        "d AS (SELECT DISTINCT * FROM events)",
        f"s AS (SELECT {cols.replace('event_type', strip + ' AS event_type')}, "
        f"{H_EVENT} AS h FROM d)",
    ]
    if gen in ("v1", "v2"):
        steps.append(f"c AS ({cap('s')})")
        prev = "c"
        if gen == "v2":
            steps.append("r AS (SELECT * FROM c WHERE event_type NOT IN ('signup'))")
            prev = "r"
        steps.append(f"m AS (SELECT * FROM (SELECT *, {sql_category('event_type')} AS category "
                     f"FROM {prev}) x WHERE category IS NOT NULL)")
    else:
        steps.append(f"m0 AS (SELECT * FROM (SELECT *, {sql_category('event_type')} AS category "
                     f"FROM s) x WHERE category IS NOT NULL)")
        steps.append(f"m AS ({cap('m0')})")
    pick = sql_pick(PICK_SEED, list(ETL_TARGETS), "event_id")
    final = f"""
SELECT event_id, event_type, category, value FROM m WHERE category != 'engagement'
UNION ALL
SELECT event_id, event_type, {pick} AS category, value FROM (
  SELECT * FROM m WHERE category = 'engagement' ORDER BY h, event_id LIMIT 1000) hd
UNION ALL
SELECT event_id, event_type, category, value FROM (
  SELECT * FROM m ORDER BY h DESC, event_id DESC LIMIT 500) tl"""
    return "WITH " + ",\n".join(steps) + final


for _gen in ("v1", "v2", "explore"):
    register(f"etl_{_gen}", _etl_sql(_gen))(
        (lambda g: lambda spark, sf_dir: _etl(spark, sf_dir, g))(_gen))


# ------------------------------------------------------- report / model files

@register("counts_report_csv", """
SELECT event_type, count(event_type) AS n FROM events GROUP BY event_type
""")
def counts_report_csv_q(spark, sf_dir):
    """Counts per label written as ONE headed CSV file, sorted by label (after
    aggregation, so the single task only sees one row per label), then read
    back."""
    from kestrel.sources.files import write_single_csv
    counts = value_counts(_events(spark, sf_dir), "event_type", count_rows=False, ordered=False)
    path = scratch_path(spark, "counts-report")
    write_single_csv(counts, path, header=True, order_by=["event_type"])
    return spark.read.schema("event_type string, n bigint").option("header", True).csv(path)


@register("model_save_load_score", _SCORED_SQL)
def model_save_load_score_q(spark, sf_dir):
    """Train on the full table, save the model, load it back and score."""
    from kestrel.operators.ml import load_model, save_model
    ev = _ml_events(spark, sf_dir)
    model = train_model(ev, label_col="category", exclude=["event_id"])
    path = scratch_path(spark, "model")
    save_model(model, path)
    return _scored(predict(load_model(path), ev.withColumnRenamed("category", "truth"), out_col="predicted"))


@register("batch_score_append", _SCORED_SQL)
def batch_score_append_q(spark, sf_dir):
    """Batch scoring as a job: append the raw rows, load the model, score, append
    the result in the layout of the processed table."""
    from kestrel.operators.ml import save_model
    from kestrel.plans.training import batch_score
    ev = _ml_events(spark, sf_dir)
    model, raw, done = (scratch_path(spark, n) for n in ("batch-model", "batch-raw", "batch-done"))
    save_model(train_model(ev, label_col="category", exclude=["event_id"]), model)
    rows = ev.withColumnRenamed("category", "truth")
    (rows.withColumn("predicted", F.lit(None).cast("string")).where("false")
     .select("predicted", "event_id", "truth", "user_id", "value", "hour", "dow", "paid").write.parquet(done))
    batch_score(model, rows, out_col="predicted", raw_path=raw, processed_path=done)
    return _scored(spark.read.parquet(done).join(spark.read.parquet(raw).select("event_id"), "event_id", "left_semi"))


@register("batch_score_runs", _SCORED_SQL)
def batch_score_runs_q(spark, sf_dir):
    """Scoring in two runs that share the middle third of the month, the second
    one run twice: the table holds every event once."""
    from kestrel.plans.training import batch_score_once
    ev = _ml_events(spark, sf_dir)
    model = train_model(ev, label_col="category", exclude=["event_id"])
    events, day = map_categories(_events(spark, sf_dir), "event_type", EVENT_CATEGORIES), F.dayofmonth("ts")
    table = scratch_path(spark, "scored-runs")
    for run, part in (("first", day <= 20), ("second", day > 10), ("second", day > 10), ("third", day > 10)):
        done = batch_score_once(model, _ml_features(events.where(part), "truth"), table, ["event_id"], run,
                                out_col="predicted", buckets=8)
    return _scored(done)


@register("train_full_score", _SCORED_SQL)
def train_full_score_q(spark, sf_dir):
    """The training job over all rows (raw and processed tables written, model
    saved), and the saved model's scores of the same rows."""
    from kestrel.operators.ml import load_model
    from kestrel.plans.training import train_on_full_data
    raw = _events(spark, sf_dir).select("event_id", F.col("event_type").alias("attack"), "value", F.hour("ts").alias("hour"),
                                        F.col("event_type").isin(EVENT_CATEGORIES["conversion"]).cast("int").alias("paid"))
    model, before, after = (scratch_path(spark, n) for n in ("full-model", "full-raw", "full-processed"))
    preset = EtlPreset(cap_label=None, mapping=EVENT_CATEGORIES, rebalance=False)
    train_on_full_data(raw, model, preset, processed_path=after, raw_path=before)
    rows = spark.read.parquet(after).withColumnRenamed("category", "truth")
    return _scored(predict(load_model(model), rows, out_col="predicted"))


@register("exploration_report", f"""
WITH m AS (SELECT event_id, event_type, value, {sql_category('event_type')} AS category, CAST(event_type = 'purchase' AS INTEGER) AS paid FROM events),
k AS (SELECT * FROM m WHERE category IS NOT NULL)
SELECT 'shape' AS section, CAST(NULL AS VARCHAR) AS label, 'n_rows' AS measure, CAST(count(*) AS DOUBLE) AS value FROM k
UNION ALL SELECT 'shape', NULL, 'n_cols', 5.0
UNION ALL SELECT 'label_counts', event_type, 'n', count(*) FROM k GROUP BY event_type
UNION ALL SELECT 'category_counts', category, 'n', count(*) FROM k GROUP BY category
UNION ALL SELECT 'duration_by_category', category, unnest(['avg_value', 'nonnull_value', 'positive_value']),
                 unnest([round(avg(value), 6), count(value), count_if(value > 0)]) FROM k GROUP BY category
UNION ALL SELECT 'attempts_by_category', category, unnest(['avg_paid', 'nonnull_paid', 'positive_paid']),
                 unnest([round(avg(paid), 6), count(paid), count_if(paid > 0)]) FROM k GROUP BY category
""")
def exploration_report_q(spark, sf_dir):
    """All frames of the exploration report as one long table."""
    from kestrel.plans.report import exploration_report, long_report
    ev = map_categories(_events(spark, sf_dir), "event_type", EVENT_CATEGORIES).select(
        "event_id", "event_type", "value", "category", (F.col("event_type") == "purchase").cast("int").alias("paid"))
    return long_report(exploration_report(ev, "event_type", "category", "value", "paid"))


@register("category_counts_join", ORACLE_SQL["category_counts"])
def category_counts_join(spark, sf_dir):
    """The flagship with its label map as a table."""
    from kestrel.functions.categorize import label_map_frame, map_categories_join
    ev = drop_duplicates(_events(spark, sf_dir))
    mapped = map_categories_join(ev, "event_type", label_map_frame(spark, EVENT_CATEGORIES))
    return mapped.groupBy("category").agg(F.count("category").alias("counts"))


def _features_with_gaps(spark, sf_dir):
    """lineitem features with NULL (zero discount) and NaN (zero tax) gaps."""
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_tax") == 0.0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"))


@register("drop_invalid_features", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0.0) AS l_discount,
         CASE WHEN l_tax = 0.0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax
  FROM lineitem) t
WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity)
  AND l_discount IS NOT NULL AND NOT isnan(l_discount)
  AND l_tax IS NOT NULL AND NOT isnan(l_tax)
""")
def drop_invalid_features_q(spark, sf_dir):
    """Rows with a NULL or NaN feature removed (the assembler's skip rule)."""
    from kestrel.operators.filters import drop_nan_rows
    return drop_nan_rows(_features_with_gaps(spark, sf_dir), ["l_quantity", "l_discount", "l_tax"])


@register("invalid_feature_counts", """
WITH t AS (
  SELECT l_quantity, nullif(l_discount, 0.0) AS l_discount,
         CASE WHEN l_tax = 0.0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax
  FROM lineitem)
SELECT count(*) AS n_rows,
       count_if(l_quantity IS NULL OR isnan(l_quantity) OR l_discount IS NULL OR isnan(l_discount)
                OR l_tax IS NULL OR isnan(l_tax)) AS n_invalid,
       count_if(l_quantity IS NULL OR isnan(l_quantity)) AS invalid_l_quantity,
       count_if(l_discount IS NULL OR isnan(l_discount)) AS invalid_l_discount,
       count_if(l_tax IS NULL OR isnan(l_tax)) AS invalid_l_tax
FROM t
""")
def invalid_feature_counts_q(spark, sf_dir):
    """What the skip rule drops, reported per column and in total."""
    from kestrel.operators.filters import invalid_feature_counts
    return invalid_feature_counts(_features_with_gaps(spark, sf_dir),
                                  ["l_quantity", "l_discount", "l_tax"])


# ------------------------------------------------- faithful stream rate forms

@register("bucket_rate_stream", """
SELECT time_stamp, count(time_stamp) AS rate FROM (
  SELECT CASE WHEN event_type = 'error' THEN NULL ELSE CAST(day(ts) AS INTEGER) END AS time_stamp
  FROM events) t
GROUP BY time_stamp
""")
def bucket_rate_stream_q(spark, sf_dir):
    """The rate job as the source ran it: each message is a CSV line whose last
    field is the producer's bucket number (here the day of month; error events
    carry none, so they form the NULL bucket with rate 0), parsed and counted
    per bucket in Complete mode."""
    from kestrel.session import table_path
    from kestrel.streaming.rate import bucket_rate
    src = parquet_table_stream(spark, table_path(sf_dir, "events"))
    msg = src.select(F.concat_ws(
        ",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
        F.col("event_type"), F.concat(F.col("value").cast("string"), F.lit("\n")),
        F.when(F.col("event_type") != "error", F.dayofmonth("ts").cast("string"))).alias("value"))
    fields = [("event_id", T.LongType()), ("user_id", T.LongType()), ("event_type", T.StringType()),
              ("value", T.DoubleType()), ("time_stamp", T.IntegerType())]
    agg = bucket_rate(parse_delimited(msg, "value", fields), "time_stamp")
    out = scratch_path(spark, "bucket-rate-out")
    run_complete_overwrite(agg, out, scratch_path(spark, "bucket-rate-ckpt"))
    return read_current(spark, out)


@register("greedy_bucket_rate", """
WITH RECURSIVE t AS (SELECT DISTINCT ts FROM events WHERE ts IS NOT NULL),
j AS MATERIALIZED (SELECT ts, min(ts) OVER (ORDER BY ts RANGE BETWEEN INTERVAL '10 seconds 1 microsecond' FOLLOWING
                                            AND UNBOUNDED FOLLOWING) AS following FROM t),
s(bucket, start) AS (
  SELECT 1::BIGINT, min(ts) FROM t
  UNION ALL
  SELECT bucket + 1, j.following FROM s JOIN j ON j.ts = s.start WHERE j.following IS NOT NULL)
SELECT s.bucket, s.start, count(*) AS rate FROM events e ASOF JOIN s ON e.ts >= s.start GROUP BY s.bucket, s.start
""")
def greedy_bucket_rate_q(spark, sf_dir):
    """The rate over the producer's own buckets: one starts with the first
    record more than ten seconds after the last start."""
    from kestrel.operators.greedy import greedy_bucket_rate
    return greedy_bucket_rate(_events(spark, sf_dir), "ts", 10.0)


def _in_files(spark, sf_dir, n: int) -> str:
    """The events as ``n`` files, so that a stream of one file a batch has as many."""
    path = scratch_path(spark, "event-files")
    _events(spark, sf_dir).repartition(n, "event_id").write.parquet(path)
    return path


@register("events_stream_commits", "SELECT event_id, ts, user_id, event_type, value FROM events")
def events_stream_commits_q(spark, sf_dir):
    """A stream of several micro-batches, each one commit of the target table;
    every third commit merges folders."""
    from kestrel.sources.manifest import ManifestTable
    from kestrel.streaming.sinks import run_append_commits
    src = parquet_table_stream(spark, _in_files(spark, sf_dir, 5), max_files_per_trigger=1)
    out = scratch_path(spark, "commits")
    run_append_commits(src.select("event_id", "ts", "user_id", "event_type", "value"), out, scratch_path(spark, "commits-ckpt"), fan=3)
    return ManifestTable(spark, out).read()


@register("rate_10s_stream_update", _rate_sql(10))
def rate_10s_stream_update_q(spark, sf_dir):
    """The ten-second rate in Update mode: each micro-batch rewrites only the
    buckets of the windows that it changed."""
    from kestrel.sources.manifest import ManifestTable
    from kestrel.streaming.sinks import run_update_commits
    src = parquet_table_stream(spark, _in_files(spark, sf_dir, 3), max_files_per_trigger=1)
    out = scratch_path(spark, "rate-update")
    run_update_commits(window_rate(src, "ts", "10 seconds"), ["window_start"], out, scratch_path(spark, "rate-update-ckpt"), buckets=16)
    return ManifestTable(spark, out).read()


@register("bucket_rate_stream_expiring", """
WITH b AS (SELECT CAST(floor(epoch_us(ts) / 3600000000) AS INTEGER) AS time_stamp FROM events WHERE event_type <> 'error')
SELECT time_stamp, count(*) AS rate FROM b WHERE time_stamp < (SELECT max(time_stamp) FROM b) GROUP BY time_stamp
""")
def bucket_rate_stream_expiring_q(spark, sf_dir):
    """Integer buckets (hours since the epoch) as event time: a bucket is
    emitted once the next one is seen, and its state is dropped.  The events
    come as three files in the order of time."""
    from kestrel.streaming.expiring import expiring_bucket_rate
    path, day = scratch_path(spark, "timed-files"), F.dayofmonth("ts")
    hour = F.floor(F.unix_micros(ntz_as_utc(F.col("ts"))) / 3_600_000_000).cast("int")
    marked = _events(spark, sf_dir).select(day.alias("day"), F.when(F.col("event_type") != "error", hour).alias("time_stamp"))
    for part in ("day <= 10", "day > 10 and day <= 20", "day > 20"):
        marked.where(part).select("time_stamp").coalesce(1).write.mode("append").parquet(path)
    out = scratch_path(spark, "expiring-out")
    run_append_by_batch(expiring_bucket_rate(parquet_table_stream(spark, path, max_files_per_trigger=1)), out,
                        scratch_path(spark, "expiring-ckpt"))
    return spark.read.parquet(out).drop("batch_id")


@register("latest_bucket_stream", f"""
WITH r AS ({_rate_sql(3600)})
SELECT window_start, rate FROM r WHERE window_start = (SELECT max(window_start) FROM r)
""")
def latest_bucket_stream_q(spark, sf_dir):
    """Complete-mode hourly rates; each micro-batch keeps only the latest
    window before overwriting the sink (the commented-out join, inside
    foreachBatch where the aggregate is a bounded batch frame)."""
    from kestrel.session import table_path
    src = parquet_table_stream(spark, table_path(sf_dir, "events"))
    agg = window_rate(src, "ts", "1 hour")
    out = scratch_path(spark, "latest-out")

    def latest(batch: DataFrame) -> DataFrame:
        return latest_only(batch, "window_start")

    run_complete_overwrite(agg, out, scratch_path(spark, "latest-ckpt"), transform=latest)
    return read_current(spark, out)


# ----------------------------------------------- survey-named query variants

def _constant_sql() -> str:
    parts = []
    for c in _F_ORDERS_COLS:
        nd = f"count(DISTINCT {c})"
        has_null = f"max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
        parts.append(f"SELECT '{c}' AS column_name, true AS null_is_value, "
                     f"({nd} + {has_null}) = 1 AS is_constant FROM f")
        parts.append(f"SELECT '{c}' AS column_name, false AS null_is_value, "
                     f"{nd} <= 1 AS is_constant FROM f")
    return f"WITH f AS {_F_ORDERS_SQL}\n" + "\nUNION ALL\n".join(parts)


@register("constant_columns", _constant_sql())
def constant_columns_q(spark, sf_dir):
    """Long form (column, null rule, constant?) for both NULL rules, from the
    one-pass profile."""
    prof = column_profile(_f_orders(spark, sf_dir))
    return prof.select("column_name", F.inline(F.array(
        F.struct(F.lit(True).alias("null_is_value"), F.col("is_constant").alias("is_constant")),
        F.struct(F.lit(False).alias("null_is_value"),
                 F.col("is_constant_ignoring_null").alias("is_constant")))))


@register("binary_metrics_events", f"""
WITH p AS (
  SELECT CASE WHEN value > {POSITIVE_THRESHOLD} THEN 'conversion' ELSE 'engagement' END AS predicted,
         {sql_category('event_type')} AS category
  FROM events),
c AS (
  SELECT count_if(predicted != 'engagement' AND category != 'engagement') AS tp,
         count_if(predicted != 'engagement' AND category = 'engagement') AS fp,
         count_if(predicted = 'engagement' AND category = 'engagement') AS tn,
         count_if(predicted = 'engagement' AND category != 'engagement') AS fn
  FROM p WHERE predicted IS NOT NULL AND category IS NOT NULL)
SELECT tp, fp, tn, fn,
  CASE WHEN fp + tn > 0 THEN round(fp / (fp + tn), 6) END AS false_positive_rate,
  CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall,
  CASE WHEN tp + fp + tn + fn > 0 THEN round((tp + tn) / (tp + fp + tn + fn), 6) END AS accuracy
FROM c
""")
def binary_metrics_events_q(spark, sf_dir):
    """String labels: a threshold rule's prediction against the mapped
    category; 'engagement' is the negative class, unmapped labels are NULL
    and not counted."""
    ev = _events(spark, sf_dir).select(
        F.when(F.col("value") > POSITIVE_THRESHOLD, F.lit("conversion"))
         .otherwise(F.lit("engagement")).alias("predicted"),
        category_of("event_type", EVENT_CATEGORIES).alias("category"))
    return binary_metrics(ev, "predicted", "category", negative="engagement")
