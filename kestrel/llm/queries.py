"""The numbered operators applied to the driver's tables with production
parameters, and their SQL twins where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (chat, decontam, embed_dedup, hard_negatives, langid, minhash_dedup, mixing, prefix_trie, quality,
                         secrets, suffix_dedup, token_counts, toxicity)
from kestrel.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return register


@query("op2_chat_formatting", """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, turn, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS line,
             md5(coalesce(role, chr(0)) || chr(1) || coalesce(text, chr(0))) AS h,
             row_number() OVER w AS n, lead(turn) OVER w IS NULL AS last
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, md5(text) NULLS FIRST)),
q AS (SELECT *, string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS pre FROM p),
e AS (SELECT pre, min(conv_id) AS conv_id, max(n) AS n_turns, count(*) AS n_copies FROM q WHERE last GROUP BY pre),
m AS (SELECT * FROM e WHERE pre NOT IN (SELECT pre FROM q WHERE NOT last))
SELECT m.conv_id, m.n_turns, m.n_copies, string_agg(p.line, '' ORDER BY p.n) AS text
FROM m JOIN p USING (conv_id) GROUP BY m.conv_id, m.n_turns, m.n_copies""")
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


#: the words of ``text``, A-Z lower-cased
_WORD_LIST = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x20\x09-\x0D]+')")


@query("op3_secret_scans", f"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS source, coalesce(text, '') AS t FROM documents),
k(kind, rank, pat) AS (VALUES ('assign', 1, '{_sql(secrets.ASSIGN)}'), ('access', 2, '{secrets.BASE["access"][0]}'),
                              ('hex', 3, '{secrets.BASE["hex"][0]}'), ('opaque', 4, '{secrets.OPAQUE}')),
f AS (SELECT doc_id, source, 1 AS rank, 'assign' AS kind, regexp_extract_all(t, '{_sql(secrets.ASSIGN)}') AS ms,
             string_split_regex(t, '{_sql(secrets.ASSIGN)}') AS gs FROM d
      UNION ALL SELECT doc_id, source, 2, 'access', regexp_extract_all(t, '{secrets.BASE["access"][0]}'),
             string_split_regex(t, '{secrets.BASE["access"][0]}') FROM d
      UNION ALL SELECT doc_id, source, 3, 'hex', regexp_extract_all(t, '{secrets.BASE["hex"][0]}'),
             string_split_regex(t, '{secrets.BASE["hex"][0]}') FROM d
      UNION ALL SELECT doc_id, source, 4, 'opaque', regexp_extract_all(t, '{secrets.OPAQUE}'),
             string_split_regex(t, '{secrets.OPAQUE}') FROM d),
u AS (SELECT doc_id, source, rank, kind, generate_subscripts(gs, 1) AS i, unnest(gs) AS g,
             unnest(list_resize(ms, len(gs))) AS m FROM f WHERE len(ms) > 0),
r AS (SELECT *, sum(length(g) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS e FROM u),
v AS (SELECT doc_id, source, rank, kind, m, e - length(m) AS s, e,
             CASE WHEN rank = 1 THEN regexp_extract(m, '{_sql(secrets.ASSIGN)}', 2) ELSE m END AS val
      FROM r WHERE m IS NOT NULL),
w AS (SELECT * FROM v WHERE (rank = 1 AND length(val) >= 12) OR rank IN (2, 3)
        OR (rank = 4 AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]'))),
o AS (SELECT val, count(DISTINCT source) < {secrets.EXAMPLE_OWNERS}
                    OR count(DISTINCT doc_id) < {secrets.EXAMPLE_REPOSITORIES} AS live FROM w GROUP BY val),
x AS (SELECT doc_id, rank, kind, s, kind || ':' || s::BIGINT || ':' || e::BIGINT AS span, live FROM w JOIN o USING (val)
      WHERE rank < 4 OR live),
y AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 4) AS base,
             string_agg(span, ',' ORDER BY s, rank) AS spans,
             count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
      FROM x GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN y USING (doc_id)""")
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(read_table(spark, sf_dir, "documents")))


@query("op10_mixing", r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  ('0x' || substr(md5('11|' || doc_id), 1, 15))::BIGINT AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w,
             2.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, sum(cap) OVER o AS caps, sum(w) OVER o AS ws, 1.5 * sum(source_size) OVER () AS goal, sum(w) OVER () AS aw
      FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
l AS (SELECT *, caps + cap / w * (aw - ws) <= goal AS is_full FROM r),
v AS (SELECT (any_value(goal) - coalesce(sum(cap) FILTER (is_full), 0)) / nullif(sum(w) FILTER (NOT is_full), 0) AS lev FROM l),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE least(cap, w * lev) END AS target FROM l, v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS ep FROM t),
b AS (SELECT d.doc_id, d.size, e.*, floor(target)::BIGINT - ep * source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id::VARCHAR) - d.size AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target,
       (ep * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM b""")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality.fit(docs))
    return scored.withColumn("keep", F.col("score") >= 0.5)


@query("op5_embedding_near_dedup", """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS s FROM v
       WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND list_dot_product(a.e, b.e) / (a.s * b.s) >= 0.98),
r AS (WITH RECURSIVE c(a, b) AS (SELECT a, b FROM l UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a)
      SELECT a, least(a, min(b)) AS root FROM c GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, coalesce(root, v.vec_id) AS component_id,
       v.vec_id = coalesce(root, v.vec_id) AS kept
FROM v LEFT JOIN r ON r.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id""")
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"), 0.98)


@query("op6_minhash_near_dedup", f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORD_LIST} AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) > 1 THEN list_sort(list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])))
                          ELSE coalesce(ws, []) END AS s FROM w),
c AS (SELECT min(doc_id) AS id, s, len(s) AS n FROM g WHERE len(s) > 0 GROUP BY s),
e AS (SELECT id, n, unnest(s) AS x FROM c),
l AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.x = b.x AND a.id <> b.id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
      GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS id, least(a, min(b)) AS root FROM r GROUP BY a)
SELECT g.doc_id, len(g.s)::BIGINT AS n_shingles, coalesce(m.root, c.id, g.doc_id) AS component_id,
       g.doc_id = coalesce(m.root, c.id, g.doc_id) AS kept
FROM g LEFT JOIN c ON c.s = g.s LEFT JOIN m ON m.id = c.id""")
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), width=2, percent=80).drop("tie")


@query("op7_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORD_LIST} AS ws FROM documents),
i AS (SELECT DISTINCT item_id, {_WORD_LIST} AS ws FROM benchmark),
q AS (SELECT *, row_number() OVER () AS r, least(5, len(ws)) AS k,
             list_distinct(list_transform(range(1, len(ws) - least(5, len(ws)) + 2), lambda j: ws[j:j + least(5, len(ws)) - 1])) AS s
      FROM i WHERE len(ws) > 0),
x AS (SELECT r, item_id, len(s) AS n, unnest(s) AS g FROM q),
y AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - k + 2), lambda j: ws[j:j + k - 1])) AS g
      FROM d, (SELECT DISTINCT k FROM q) WHERE len(ws) >= k),
m AS (SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared FROM x JOIN y USING (g) GROUP BY doc_id, r, item_id, n
      HAVING 100 * count(*) >= 80 * n)
SELECT *, n_shared / n_shingles AS containment FROM m
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_shared / n_shingles DESC, n_shingles DESC) = 1""")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = langid.fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return (langid.identify(docs, model).withColumn("held_out", held_out)
            .select("doc_id", "held_out", "lang_pred", "score", "accepted"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = langid.fold(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, labels.where(~held_out).select("doc_id", F.col("toxic").alias("y")))
    return (toxicity.score_texts(docs, model)
            .select("doc_id", held_out.alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))


@query("op1_suffix_dedup", """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, p, b[p:p + 49] AS g FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 48)) AS p FROM d)),
f AS (SELECT g, min(doc_id) AS low FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
m AS (SELECT doc_id, p, p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 AS gap FROM w JOIN f USING (g) WHERE doc_id > low),
i AS (SELECT doc_id, p, count(*) FILTER (gap) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM m),
s AS (SELECT doc_id, min(p) AS lo, max(p) + 50 AS hi FROM i GROUP BY doc_id, k),
l AS (SELECT doc_id, lo, coalesce(lag(hi) OVER o, 1) AS since, hi, lead(lo) OVER o IS NULL AS last FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY lo)),
r AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans,
             string_agg(hex(b[since:lo - 1]), '' ORDER BY lo) || max(CASE WHEN last THEN hex(b[hi:octet_length(b)]) ELSE '' END) AS kept
      FROM l JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(kept)) END AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)""")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op12_conversation_trie", """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, m, length(text) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, m) AS k
      FROM (SELECT *, md5(length(role) || ':' || role || text) AS m FROM t)),
z AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS head, count(*) AS n,
             xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(conv_id::VARCHAR) + 1),
                                         lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
                             lambda x, y: xor(x >> 8, any_value(crc)[(1 + (xor(x, y) & 255))::INT])), 4294967295) % 6 AS h
      FROM t, z GROUP BY conv_id),
r AS (SELECT c.conv_id, o.k AS d, m, chars FROM c JOIN o ON o.conv_id = c.head AND o.k <= c.h
      UNION ALL
      SELECT c.conv_id, o.k - c.h + least(c.h, coalesce(b.n, 0)), m, chars
      FROM c JOIN o ON o.conv_id = c.conv_id AND o.k > c.h LEFT JOIN c b ON b.conv_id = c.head),
p AS (SELECT conv_id, d, chars, string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY d) AS pre FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT pre, max(d) AS d, min(conv_id) AS conv_id, count(*) AS n, max(chars) AS chars FROM p GROUP BY pre),
k AS (SELECT left(pre, -32) AS pre, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
e AS (SELECT pre, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
      FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS deepest FROM p) WHERE d = deepest GROUP BY pre),
x AS (SELECT n.*, coalesce(kids, 0) AS kids, coalesce(ids, '') AS ids FROM n LEFT JOIN k USING (pre) LEFT JOIN e USING (pre)),
s AS (SELECT left(pre, 32 * unnest(range(d + 1))::INT) AS pre, (n - 1) * chars AS own, (kids = 0)::INT AS leaf FROM x),
u AS (SELECT pre, sum(own)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves FROM s GROUP BY pre)
SELECT x.conv_id, x.d::BIGINT AS depth, q.conv_id AS parent_conv_id, x.n AS n_convs, x.kids AS n_children, u.leaves AS n_leaves,
       u.saved AS saved_tokens, sha256(x.ids) AS ends_sha256
FROM x JOIN u USING (pre) LEFT JOIN n q ON x.d > 0 AND q.pre = left(x.pre, -32)""")
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(read_table(spark, sf_dir, "conversations"),
                                                       turns=prefix_trie.shared_opening()))


@query("op13_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, list_dot_product(a.q, v.q)::BIGINT AS score
      FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = read_table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)
