import corpus_pipeline
from kestrel.llm import quality, secrets
from tests.llm.data import documents, odd_texts
from tests.llm.test_decontam import brute_force as leaks
from tests.llm.test_minhash_dedup import brute_force as components

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_one_by_one(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    docs, kept = raw, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).persist()
        kept.append((name, docs, out))
        docs = out
    (_, d, good), (_, _, once), (_, _, clean), (_, _, safe), (_, _, mixed) = kept
    assert [n for n, _, _ in kept] == ["quality", "near_dedup", "decontaminate", "secrets", "mix"]
    assert all(out.columns == raw.columns for _, _, out in kept[:-1])

    scores = {r.doc_id: r.score for r in quality.score_quality(d, quality.fit(d)).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.5}

    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in once.collect()} == {int(i) for i, _, c in components(rows, 5) if int(i) == c}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in once.collect()]
    bad = {int(i) for i, _ in leaks(rows, items)}
    assert bad and {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - bad

    found = {r.doc_id: r for r in secrets.digest(secrets.scan_secrets(clean)).collect()}
    before, after = ({r.doc_id: r for r in t.collect()} for t in (clean, safe))
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert (r.text != before[i].text) == (found[i].n_live > 0)
        assert r.n_chars == len(r.text)

    assert mixed.columns[:len(raw.columns)] == raw.columns and mixed.where("taken = 0").isEmpty()
    assert {r.doc_id for r in mixed.collect()} <= after.keys()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in mixed.collect())


def test_odd_rows_pass_every_stage(spark):
    docs = documents(spark, odd_texts(), ids=[None, 1, 1, *range(3, len(odd_texts()))],
                     sources=[None] * 5 + ["a"] * (len(odd_texts()) - 5))
    empty = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, empty):
            out = stage(spark, table, SF)
            rows = out.collect()
            assert name == "mix" or out.columns == docs.columns
            assert table is docs or rows == []
