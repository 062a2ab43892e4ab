"""Small documents with every oddity that the operators define a result for."""

from __future__ import annotations

import random

LONG_WORDS = 60_000
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "size string, keys string, spans string, hash string, band string, root string, id string, n int")


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if rng.random() < .1 else ''}" for _ in range(n))


def documents(spark, texts, sources=None, langs=None, ids=None):
    """A documents table with extra columns whose names operators also use."""
    rows = []
    for i, text in enumerate(texts):
        rows.append((ids[i] if ids else i, text, langs[i] if langs else "en", sources[i] if sources else f"s{i % 3}",
                     len(text) if text is not None else None, *["x"] * 7, 1))
    return spark.createDataFrame(rows, DOC_SCHEMA)


def odd_texts() -> list:
    base = prose(1, 300)
    words = base.split()
    near = " ".join([*words[:150], "changed", *words[151:]])
    passage = prose(2, 80)
    return [base, base, near, None, "", "   \n\t ", "one", "one", "two words", "é ß ñ", passage,
            prose(3, 40) + " " + passage + " " + prose(4, 40), prose(5, 100) + passage, prose(6, LONG_WORDS, 50_000),
            " ".join(["same"] * 500), " ".join(["same"] * 400), "\x00\x01 odd \U0001f600 bytes", base.upper()]
