import math

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import toxicity
from kestrel.llm.langid import fold
from kestrel.llm.queries import QUERIES
from kestrel.llm.text import utf8_bytes
from tests.llm.data import documents, odd_texts, prose

import pyarrow as pa

SF = "/root/testdata/sf0.1"


def scores(model, texts):
    return model.score(*utf8_bytes(pa.array([t.lower() for t in texts])))


def test_held_out_quality(spark):
    out = QUERIES["op9_toxicity"](spark, SF).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(fold(F.col("doc_id"), 3) == 1).toPandas().set_index("doc_id").toxic
    got = out.loc[labels.index]
    assert got.held_out.all() and out.score.between(0, 1).all() and set(out.predicted) == {0, 1}
    assert (got.predicted[labels == 0] == 0).mean() >= 0.99
    assert (got.predicted[labels == 1] == 1).mean() >= 0.75
    assert out.held_out.mean() > 0.3


def mentions(fairness):
    """Group ``women`` is mentioned mostly in toxic texts, neutral ones exist."""
    rng = np.random.default_rng(0)
    words, y = [], []
    for k in range(3000):
        toxic = k % 5 == 0
        w = prose(k, 20).split() + (["scum"] if toxic and rng.random() < 0.9 else [])
        if rng.random() < (0.6 if toxic else 0.05):
            w.append("women")
        words.append(" ".join(w))
        y.append(float(toxic))
    doc, bucket = toxicity.present(*utf8_bytes(pa.array(words)))
    rows = [bucket[doc == i] for i in range(len(words))]
    return toxicity.fit_model(rows, np.array(y), fairness=fairness)


def test_counterfactual_penalty_frees_neutral_mentions():
    plain, fair = mentions(0.0), mentions(5.0)
    texts = ["the women met", "the men met", "scum of the earth", "women are scum"]
    a, b = scores(plain, texts), scores(fair, texts)
    assert a[0] - a[1] > 0.1 and abs(b[0] - b[1]) < 0.05
    assert b[2] > 0.7 and b[3] > 0.7


def test_odd_rows(spark):
    texts = [*odd_texts(), "SCUM!! idiot", "scum, idiot", *[prose(k, 30) + (" scum idiot" if k % 2 else "") for k in range(60)]]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2 if i >= 20 else None, 1) for i in range(len(texts))] + [(None, 1, 1), (21, 1, 1), (21, 5, 1)],
                                   "doc_id long, y int, text int")
    model = toxicity.fit(docs, labels)
    rows = {r.doc_id: r.score for r in toxicity.score_texts(docs, model).collect()}
    assert len(rows) == len(texts) and all(0 <= s <= 1 for s in rows.values())
    assert rows[3] == rows[4] < 0.5 and rows[18] == rows[19] > 0.5


def test_nothing_to_learn(spark):
    docs = documents(spark, ["a", None])
    none = spark.createDataFrame([], "doc_id long, y int")
    assert toxicity.fit(docs, none) is None and toxicity.fit(documents(spark, []), none) is None
    one = spark.createDataFrame([(0, 1)], "doc_id long, y int")
    assert toxicity.fit(docs, one) is None
    assert [r.score for r in toxicity.score_texts(docs, None).collect()] == [0.0, 0.0]


def test_a_small_balanced_table_is_learned(spark):
    texts = [prose(k, 30) + (" scum" if k % 2 else "") for k in range(48)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(48)], "doc_id long, y int")
    model = toxicity.fit(documents(spark, texts), labels)
    new = scores(model, [prose(100 + k, 30) + (" scum" if k % 2 else "") for k in range(20)])
    assert (new[1::2] >= 0.7).all() and (new[::2] < 0.5).all()


def plain_loss(model, rows, y, fairness, ridge=1e-6):
    """The loss by plain loops: swapped sets, score changes."""
    terms = toxicity.term_buckets(toxicity.IDENTITY_TERMS)

    def score(have):
        return 1 / (1 + math.exp(-(model.bias + sum(float(model.weight[b]) for b in have))))

    total = changes = 0.0
    for r, label in zip(rows, y):
        have, s = set(r.tolist()), score(set(r.tolist()))
        total -= math.log(s if label else 1 - s)
        for group in terms:
            for t in (t for t in group if t in have):
                for u in [None, *[g for g in group if g != t]]:
                    changes += (s - score((have - {t}) | ({u} if u is not None else set()))) ** 2
    weights = model.weight.astype(float)
    return total / len(y) + fairness / 0.05**2 * changes / len(y) + ridge * (weights**2).sum()


def sentences():
    rng = np.random.default_rng(4)
    texts, y = [], []
    for k in range(240):
        toxic = k % 3 == 0
        w = [f"w{i}" for i in rng.integers(0, 40, 4)] + (["scum"] if toxic and rng.random() < 0.8 else [])
        w += ["women"] if rng.random() < (0.6 if toxic else 0.1) else []
        w += ["men"] if rng.random() < 0.15 else []          # some hold both terms
        texts.append(" ".join([*w, f"only{k}"]))
        y.append(float(toxic))
    doc, bucket = toxicity.present(*utf8_bytes(pa.array(texts)))
    return [bucket[doc == i] for i in range(len(texts))], np.array(y)


def test_the_fit_is_a_minimum_of_the_loss_by_plain_loops():
    rows, y = sentences()
    model = toxicity.fit_model(rows, y, fairness=1.0, least_z=4.0)
    best = plain_loss(model, rows, y, 1.0)
    told = np.flatnonzero(model.weight)
    assert len(told) >= 2
    for b in [None, *told]:
        for shift in (-0.02, 0.02):
            weight = model.weight.copy()
            if b is not None:
                weight[b] += shift
            moved = toxicity.Model(model.bias + (shift if b is None else 0), weight)
            assert plain_loss(moved, rows, y, 1.0) >= best - 1e-7
    # the linear term's change, which is only the start, is another minimum
    start = toxicity.fit_model(rows, y, fairness=0.0, least_z=4.0)
    assert plain_loss(start, rows, y, 1.0) > best


def test_swapped_copies():
    x = np.zeros((3, 4))
    x[0, [0, 1]] = 1      # both terms of the first kind
    x[1, 2] = 1
    row, gone, come = toxicity.counterfactuals(x, [[0, 1], [2, 3]])
    assert sorted(zip(row.tolist(), gone.tolist(), come.tolist())) == [(0, 0, -1), (0, 0, 1), (0, 1, -1), (0, 1, 0), (1, 2, -1), (1, 2, 3)]
    p = toxicity._Penalised(x, np.array([1.0, 0, 0]), (row, gone, come), 7.0, np.full(4, 0.1))
    w = np.array([0.3, -1.0, 2.0, 0.5])
    slope, _ = p.step(w, lot=2)
    for i in range(4):
        e = np.eye(4)[i] * 1e-6
        assert abs((p.loss(w + e) - p.loss(w - e)) / 2e-6 - slope[i]) < 1e-6


def test_copies_do_not_fill_the_sample(spark):
    texts = [prose(1, 30)] * 300 + [prose(k, 30) + (" scum" if k % 2 else "") for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2 if k >= 300 else 0) for k in range(360)], "doc_id long, y int")
    sample = toxicity.labelled_sample(documents(spark, texts), labels, 1000).collect()
    assert len(sample) == len({(r.text, r.y) for r in sample}) == 61
