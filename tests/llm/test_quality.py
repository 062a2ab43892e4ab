import numpy as np

from kestrel.llm import quality
from kestrel.llm.queries import QUERIES
from tests.llm.data import documents, odd_texts, prose

SF = "/root/testdata/sf0.01"


def test_agrees_with_true_labels(spark):
    """The labels were never seen; clean documents stay."""
    out = QUERIES["op4_quality_classifier"](spark, SF).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    keep = out.keep[labels.index]
    assert keep[labels == 1].mean() >= 0.99
    assert (~keep[labels == 0]).mean() >= 0.8
    assert len(out) == 1000 and out.score.between(0, 1).all()


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    v = np.stack([np.where(rng.random(20_000) < 0.3, quality.ABSTAIN,
                           np.where(rng.random(20_000) < np.where(good, 0.03, miss), quality.BAD, quality.GOOD))
                  for miss in (0.9, 0.7, 0.6, 0.5)], axis=1)
    codes, at, n = np.unique(quality.pattern_code(v), return_inverse=True, return_counts=True)
    posterior, chance = quality.label_model(codes, n.astype(float), 4)
    assert np.abs(chance[:, 0, 0] - [0.9, 0.7, 0.6, 0.5]).max() < 0.05
    assert np.abs(chance[:, 1, 0] - 0.03).max() < 0.02
    assert ((posterior[at] > 0.5) == good).mean() > 0.95


def test_odd_rows(spark):
    texts = odd_texts() + ["### &&& *** %%% $$$ " * 30, *[prose(100 + i, 60) for i in range(40)]]
    docs = documents(spark, texts, ids=[None, 1, 1, *range(3, len(texts))])
    model = quality.fit(docs)
    out = quality.score_quality(docs, model).collect()
    assert len(out) == len(texts) and all(0 <= r.score <= 1 for r in out)
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in out if r.score < 0.5} == {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    scores = {r.doc_id: r.score for r in out}
    assert scores[3] == scores[4] == 0.5          # null and empty


def test_empty_table(spark):
    docs = documents(spark, [])
    assert quality.fit(docs) is None
    assert quality.keep_good(docs, None).collect() == [] and quality.score_quality(docs, None).collect() == []
    blank = documents(spark, [None, ""])
    assert quality.keep_good(blank, quality.fit(blank)).count() == 2


def test_copies_do_not_fill_the_sample(spark):
    """Half of the rows are one text, whichever its hash: the sample has it
    once at most and isn't cut by its limit."""
    texts = [prose(k, 12) for k in range(400)]
    for copied in texts[:12]:
        sample = [r.text for r in quality.sample_texts(documents(spark, texts + [copied] * 400 + [None, ""]), 100).collect()]
        assert len(set(sample)) == len(sample) and 50 < len(sample) <= 100
