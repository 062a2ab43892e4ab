import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kestrel.llm import token_counts as tc
from kestrel.llm.queries import QUERIES
from kestrel.session import read_table
from tests.llm.data import documents, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TABLE = tc.read_merges(PATH)


@lru_cache
def library():
    return Tokenizer.from_file(PATH)


def want(text):
    return len(library().encode(text or "", add_special_tokens=False).ids)


def got(texts, **kw):
    return tc.count_texts(TABLE, iter(texts), len(texts), **kw).tolist()


def random_text(rng, n):
    kinds = ["abcdefghij", "ABC", "0123", "  ", "\n\t", "'", "'s't're'll", ".,!?-", "éßñ", "日本語", "\U0001f600", " 　\x1c\x85",
             "͸᫏\U00031350꟏", "<|endoftext|>", "<|", "|>"]
    return "".join(rng.choice(k) if len(k) < 13 else k for k in rng.choices(kinds, weights=[30, 3, 4, 12, 3, 4, 2, 5, 3, 2, 1, 2, 1, 1, 1, 1], k=n))


def test_random_texts_as_the_library_counts_them():
    rng = random.Random(3)
    texts = [random_text(rng, rng.randrange(0, 400)) for _ in range(1500)]
    assert got(texts) == [want(t) for t in texts]


def test_every_code_point_has_the_class_of_the_library():
    for lo in range(0, 0x110000, 0x4000):
        texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}!" for c in range(i, i + 64) if not 0xD800 <= c < 0xE000)
                 for i in range(lo, lo + 0x4000, 64)]
        if lo > 0x40000 and lo < 0xE0000:
            texts = texts[:2]      # unassigned planes
        assert got(texts) == [want(t) for t in texts], hex(lo)


def test_special_strings_are_one_token_each():
    texts = ["<|endoftext|>", "a<|endoftext|>b", " <|endoftext|><|endoftext|> ", "<|endoftext", "x <|endoftext|>s"]
    assert got(texts) == [want(t) for t in texts]
    assert got(texts[:1]) == [1]


def test_long_sequences_and_runs():
    rng = random.Random(5)
    texts = ["a" * n for n in (255, 256, 257, 1000, 4097)] + [" " * 700 + "x", "ab" * 900, "." * 1501, "=-" * 333]
    texts += ["".join(rng.choices("etaoinshrdlu", k=n)) for n in (300, 3000, 30000)]
    texts += ["".join(rng.choices("日本語éñ́", k=2000))]
    assert got(texts) == [want(t) for t in texts]


def test_both_ways_of_merging_agree():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 200):
        for alphabet in (2, 12, 256):
            raw = rng.integers(97 if alphabet < 256 else 0, 97 + alphabet if alphabet < 256 else 256, n)
            sym = TABLE.byte_symbol[raw]
            assert tc.merge_rounds(TABLE, sym, np.array([n])).tolist() == [tc.merge_by_rank(TABLE, sym)]


def test_pieces_of_long_texts_add_up():
    rng = random.Random(9)
    text = random_text(rng, 5000)
    assert got([text], chunk=50) == got([text], chunk=10**9) == [want(text)]
    assert got([text, None, "", text], chunk=7) == [want(text), 0, 0, want(text)]


def test_cache_is_only_a_cache(monkeypatch):
    monkeypatch.setattr(tc, "CACHE_CHARS", 10)
    texts = odd_texts()[:8]
    assert got(texts, chunk=100) == [want(t) for t in texts]


def test_rows(spark):
    texts = odd_texts()
    rows = tc.count_tokens(documents(spark, texts, ids=[None, *range(1, len(texts))]), PATH, limit=20).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == sorted(
        (str(i or None), len((t or "").encode()), want(t), want(t) > 20) for i, t in enumerate(texts))


def test_empty_table(spark):
    assert tc.count_tokens(documents(spark, []), PATH).collect() == []


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tc.read_merges(public_tokenizers.path("word_bpe_49k.json"))


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_counts"](spark, sf).collect()}
    docs = read_table(spark, sf, "documents").collect()
    assert rows == {d.doc_id: (len((d.text or "").encode()), want(d.text), want(d.text) > 512) for d in docs}
