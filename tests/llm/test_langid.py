from pyspark.sql import functions as F

from kestrel.llm import langid
from kestrel.llm.queries import QUERIES
from tests.llm.data import documents, odd_texts

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = QUERIES["op8_language_id"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    held = out[out.held_out]
    assert 200 < len(held) < 300 and len(out) == 1000
    assert (held.lang_pred == docs.lang[held.index]).mean() >= 0.97
    assert out.score.between(0, 1).all() and out.accepted.mean() > 0.9


def test_held_out_rows_and_other_columns_teach_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = langid.fold(F.col("doc_id"), 4) == 2
    changed = docs.withColumns({"lang": F.when(held, F.lit("zz")).otherwise(F.col("lang")), "source": F.lit("s")})
    changed.write.parquet(f"{tmp_path}/documents.parquet")
    one = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op8_language_id"](spark, SF).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op8_language_id"](spark, str(tmp_path)).collect()}
    assert one == two


def test_rejects_what_is_far_from_all(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    far = documents(spark, ["привет мир как дела сегодня", "qzx qzx xqz zzq", "日本語 の 文章"])
    rows = langid.identify(far, model).collect()
    assert not any(r.accepted for r in rows) and all(r.lang_pred in model.language for r in rows)


def test_odd_rows(spark):
    texts = odd_texts() + ["123 456 !!", "\U0001f600"]
    langs = [None if i % 5 == 0 else "ab"[i % 2] for i in range(len(texts))]
    docs = documents(spark, texts, langs=langs, ids=[None, 1, 1, *range(3, len(texts))])
    model = langid.fit(docs)
    rows = langid.identify(docs, model).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts):
        if i >= 3 and not any(c.isalpha() for c in t or ""):
            assert (by[i].lang_pred, by[i].score, by[i].accepted) == ("und", 0.0, False)
    assert all(r.lang_pred in ("a", "b", "und") and 0 <= r.score <= 1 for r in rows)


def test_nothing_to_learn(spark):
    empty = documents(spark, [])
    assert langid.fit(empty) is None and langid.identify(empty, None).collect() == []
    unlabelled = documents(spark, ["some words"], langs=[None])
    assert langid.fit(unlabelled) is None
    assert langid.identify(unlabelled, None).first().lang_pred == "und"
