import re

import numpy as np

from kestrel.llm import decontam
from kestrel.llm.queries import QUERIES
from tests.llm.data import documents, odd_texts, prose
from tests.llm.test_minhash_dedup import shingles

ITEMS = "item_id long, text string, doc_id string, n_shingles int"


def items_table(spark, items):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in items], ITEMS)


def plain_words(text):
    """Words of a text, lower-cased as the operator does (A-Z only)."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0D]+", lower) if w]


def brute_force(docs, items, width=5, least=0.8):
    out = {}
    for d, text in docs:
        have, row = shingles(text, width), f" {' '.join(plain_words(text))} "
        for i, t in items:
            if len(plain_words(t)) < width:       # a short item: a search for its words
                if plain_words(t) and f" {' '.join(plain_words(t))} " in row:
                    out[str(d), str(i)] = 1.0
                continue
            want = shingles(t, width)
            if want and len(want & have) >= least * len(want) - 1e-9:
                out[str(d), str(i)] = max(out.get((str(d), str(i)), 0), len(want & have) / len(want))
    return out


def result(df):
    rows = df.collect()
    out = {(str(r.doc_id), str(r.item_id)): r.containment for r in rows}
    assert len(out) == len(rows)
    return out


def test_items_in_documents_of_all_sizes(spark):
    rng = np.random.default_rng(0)
    items = [(k, prose(5000 + k, int(n))) for k, n in enumerate([*range(1, 40), 60, 100, 200])]
    texts = odd_texts()
    for k, (_, t) in enumerate(items):
        w = t.split()
        for size in (0, 20, 300, 3000):
            part = w[:max(1, int(len(w) * rng.choice([1.0, 0.95, 0.85, 0.7])))]
            half = len(part) // 2 if rng.random() < 0.3 else len(part)     # sometimes in two places
            texts.append(" ".join([prose(9000 + k, size), *part[:half], prose(9500 + k, 5 if half < len(part) else 0), *part[half:],
                                   prose(9900 + k, size)]))
    docs = documents(spark, texts)
    got = result(decontam.contained_items(docs, items_table(spark, items)))
    want = brute_force(list(enumerate(texts)), items)
    assert got == want and len(want) > 60


def test_short_items_inside_long_documents(spark):
    long = prose(3, 5000)
    items = [(1, "magic answer"), (2, "MAGIC"), (3, "forty two is it"), (4, "answer\tforty"), (5, "is it not so?"), (6, "magic\nanswer"),
             (7, "ans"), (8, long.split()[4000]), (9, "five words are a shingle")]
    texts = ["magic answer", f"{long} the Magic  answer {long}", f"{long[:300]} answer forty two is it", "magic-answer", "answer magic",
             f"{long} forty two is", "it is it not so? five words are a shingle", None, "magic"]
    docs, table = documents(spark, texts), items_table(spark, items)
    got, want = result(decontam.contained_items(docs, table)), brute_force(list(enumerate(texts)), items)
    assert got == want and ("1", "1") in got and ("2", "3") in got and ("1", "8") in got and ("3", "2") not in got
    assert result(decontam.contained_items(docs, table, block_bytes=60)) == want
    left = {str(i) for i in range(len(texts))} - {d for d, _ in want}
    assert {str(r.doc_id) for r in decontam.drop_contaminated(docs, table, block_bytes=60).collect()} == left


def test_one_index_per_task(spark):
    items = [(k, prose(5000 + k, 30)) for k in range(40)]
    docs, table = documents(spark, [prose(k, 50) for k in range(5)]), items_table(spark, items)
    assert len(list(decontam._blocks(table, 5, 2000))) > 2
    plan = decontam.drop_contaminated(docs, table, block_bytes=2000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_blocks_of_items_give_the_same(spark):
    items = [(k, prose(5000 + k, 30)) for k in range(40)]
    texts = [prose(k, 50) + " " + t for k, (_, t) in enumerate(items)]
    docs, table = documents(spark, texts), items_table(spark, items)
    assert result(decontam.contained_items(docs, table, block_bytes=2000)) == {(str(k), str(k)): 1.0 for k in range(40)}
    assert decontam.drop_contaminated(docs, table, block_bytes=2000).count() == 0


def test_a_repeated_item_is_held_once(spark):
    items = [(k, prose(5000 + k, 30)) for k in range(20)]
    table = items_table(spark, items + items[:1] * 300)
    blocks = list(decontam._blocks(table, 5, 2000))
    assert sorted(i for b in blocks for i in b.ids) == list(range(20)) and len(blocks) > 1
    docs = documents(spark, [items[0][1]])
    assert result(decontam.contained_items(docs, table, block_bytes=2000)) == {("0", "0"): 1.0}


def test_nulls_repeats_and_filter(spark):
    leak, clean = prose(1, 30), prose(2, 200)
    items = [(1, leak), (1, leak + " and a longer version of it with many more words"), (None, leak), (2, None), (3, ""), (4, "a b")]
    texts, ids = [leak, "x " + leak, clean, None, "", "a b", "a b c"], [None, 5, 6, 7, 8, 9, 9]
    docs, table = documents(spark, texts, ids=ids), items_table(spark, items)
    assert result(decontam.contained_items(docs, table)) == brute_force(list(zip(ids, texts)), items)
    kept = decontam.drop_contaminated(docs, table)
    assert kept.schema == docs.schema
    assert sorted(str(r.text) for r in kept.collect()) == sorted(map(str, [clean, None, ""]))


def test_empty_tables(spark):
    docs, items = documents(spark, ["a b c d e f"]), items_table(spark, [(1, "a b c d e f")])
    assert decontam.contained_items(docs, items_table(spark, [])).collect() == []
    assert decontam.contained_items(documents(spark, []), items).collect() == []
    assert decontam.drop_contaminated(docs, items_table(spark, [])).count() == 1
    assert decontam.drop_contaminated(documents(spark, []), items).collect() == []


def test_query_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert result(QUERIES["op7_benchmark_decontamination"](spark, sf)) == brute_force(docs, items)
