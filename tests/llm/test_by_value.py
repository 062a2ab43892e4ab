"""The trained operators' results recomputed by plain loops over bytes."""

import math
import re

import numpy as np
import pytest

from kestrel.llm import langid, quality
from tests.llm.data import documents, odd_texts, prose

WORD = 2**64 - 1
TEXTS = [t for t in odd_texts() if t is None or len(t) < 20_000] + [
    "### &&& *** %%% $$$ " * 30, "ALL OF THIS IS SHOUTED AT YOU, AGAIN AND AGAIN! " * 5, "12 34 56 78 90 11 12 13 14 15 16",
    "a b c d e f g h i j k l", "the the the cat cat sat sat on on the the mat mat", "Ünïcödé wörds ärë hërë, tøø: ñandú",
    *[prose(300 + k, 5 + 9 * k) for k in range(12)]]


def kind(byte: int) -> int:
    c = chr(byte)
    if c in " \t\n\v\f\r":
        return 4
    if byte >= 128 or "a" <= c <= "z":
        return 1
    if "A" <= c <= "Z":
        return 2
    if "0" <= c <= "9":
        return 3
    return 5 if c in "#$%&*|!<>{}[]=^~_\\/@+" else 6 if c in ".,;:?'\"-()" else 0


def plain_statistics(text: bytes) -> dict:
    kinds = [kind(b) for b in text]
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", text) if w]
    low = [w.lower() for w in words]
    ink, letters, n = sum(k != 4 for k in kinds), sum(k in (1, 2) for k in kinds), len(words)
    share = lambda a, b: a / b if b else math.nan
    long = lambda a: a / n if n >= quality.LEAST_WORDS else math.nan
    return {"symbol_share": share(kinds.count(5), ink),
            "symbol_words": long(sum(any(kind(b) == 5 for b in w) for w in words)),
            "upper_share": share(kinds.count(2), letters), "digit_share": share(kinds.count(3), ink),
            "repeats": 1 - len(set(low)) / min(n, 6 * math.sqrt(n)) if n >= quality.LEAST_WORDS else math.nan,
            "neighbours": long(sum(a == b for a, b in zip(low, low[1:]))),
            "odd_length": long(sum(len(w) < 2 or len(w) > 24 for w in words))}


def plain_votes(text: bytes) -> list[int]:
    stats, out = plain_statistics(text), []
    for stat, bad, good in quality.HEURISTICS.values():
        v = stats[stat]
        out.append(quality.ABSTAIN if math.isnan(v) else quality.BAD if v >= bad else quality.GOOD if v <= good else quality.ABSTAIN)
    return out


def mixed(h: int) -> int:
    for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> 33)) * c & WORD
    return h ^ (h >> 33)


def plain_quality(text: bytes, model: quality.Model) -> float:
    if not text:
        return 0.5
    kinds, z = [kind(b) for b in text], model.bias
    slot = lambda code: (code * 2654435761 & 0xFFFFFFFF) >> 32 - quality.BITS
    for codes in ([a << 16 | b << 8 | c for a, b, c in zip(text, text[1:], text[2:])],
                  [(a * 49 + b * 7 + c) | 1 << 24 for a, b, c in zip(kinds, kinds[1:], kinds[2:])]):
        counts: dict[int, int] = {}
        for code in codes:
            counts[slot(code)] = counts.get(slot(code), 0) + 1
        size = math.sqrt(sum(counts.values()))
        z += sum(math.sqrt(n) / size * float(model.weight[k]) for k, n in counts.items())
    for j, v in enumerate(plain_statistics(text).values()):
        step = -2 if math.isnan(v) else int(min(max(v * 20, -1), 20))
        z += float(model.weight[mixed((j + 1) << 32 | step + 3) >> 64 - quality.BITS])
    return 1 / (1 + math.exp(-z))


def plain_em(patterns: list[tuple[int, ...]], counts: list[float], rounds: int) -> list[float]:
    """Posterior of good per pattern; a vote's chance per class is a ratio of
    smoothed expected counts, and no heuristic is worse than blind."""
    heuristics, prior = range(len(patterns[0])), [0.2, 0.8]
    chance = [[{quality.BAD: 0.35, quality.GOOD: 0.65}, {quality.BAD: 0.02, quality.GOOD: 0.98}] for _ in heuristics]
    post = []
    for _ in range(rounds):
        post = []
        for p in patterns:
            like = [prior[c] * math.prod(chance[j][c][v] for j, v in enumerate(p) if v != quality.ABSTAIN) for c in (0, 1)]
            post.append([x / sum(like) for x in like])
        for j in heuristics:
            for c in (0, 1):
                seen = {v: 0.5 + sum(n * q[c] for p, q, n in zip(patterns, post, counts) if p[j] == v) for v in (quality.BAD, quality.GOOD)}
                chance[j][c] = {v: x / sum(seen.values()) for v, x in seen.items()}
            if chance[j][1][quality.BAD] > chance[j][0][quality.BAD]:
                both = {v: (chance[j][0][v] + chance[j][1][v]) / 2 for v in (quality.BAD, quality.GOOD)}
                chance[j] = [both, dict(both)]
        mass = [sum(n * q[c] for q, n in zip(post, counts)) for c in (0, 1)]
        prior = [(m + 1) / (sum(mass) + 2) for m in mass]
    return [q[1] for q in post]


def test_vote_counts_of_a_table(spark):
    rows = [(t or "").encode() for t in TEXTS] + [TEXTS[0].encode()] * 5
    want: dict[int, int] = {}
    for t in rows:
        code = sum(v * 3 ** j for j, v in enumerate(plain_votes(t)))
        want[code] = want.get(code, 0) + 1
    codes, counts = quality.vote_table(documents(spark, TEXTS + [TEXTS[0]] * 5))
    assert dict(zip(codes.tolist(), counts.tolist())) == want and len(want) > 5


@pytest.mark.parametrize("seed", range(4))
def test_label_model(seed):
    rng = np.random.default_rng(seed)
    votes = sorted({tuple(int(x) for x in rng.choice(3, 4, p=[0.3, 0.2, 0.5])) for _ in range(40)})
    counts = rng.integers(1, 500, len(votes)).astype(float)
    codes = np.array([sum(v * 3 ** j for j, v in enumerate(p)) for p in votes])
    got, _ = quality.label_model(codes, counts, 4, rounds=50)
    assert np.abs(got - plain_em(votes, counts.tolist(), 50)).max() < 1e-9


def test_quality_scores(spark):
    docs = documents(spark, TEXTS)
    model = quality.fit(docs)
    for r in quality.score_quality(docs, model).collect():
        text = (TEXTS[r.doc_id] or "").encode()
        votes = plain_votes(text)
        assert abs(r.score - plain_quality(text, model)) < 1e-4
        assert (r.bad_votes, r.good_votes) == (votes.count(quality.BAD), votes.count(quality.GOOD))


def plain_grams(text: str) -> dict[int, int]:
    letters = [b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()]
    counts: dict[int, int] = {}
    for gram in zip(letters, letters[1:], letters[2:]):
        if gram != (32, 32, 32):
            code = gram[0] << 16 | gram[1] << 8 | gram[2]
            slot = (code * 2654435761 & 0xFFFFFFFF) >> 32 - (langid.DIM.bit_length() - 1)
            counts[slot] = counts.get(slot, 0) + 1
    return counts


def test_languages(spark):
    """Document frequencies, TF-IDF vectors, cosines, the nearest centroid and
    the rejection, given the fitted centroids."""
    raw = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    raw = [r for r in raw if len(r[1] or "") < 4_000]
    docs = documents(spark, [t for _, t, _ in raw], langs=[lang for _, _, lang in raw])
    model = langid.fit(docs, per_language=20)
    train = [plain_grams(t) for _, t, lang in raw if lang is not None and any(c.isalpha() for c in t or "")]
    idf = [1 + math.log((1 + len(train)) / (1 + sum(k in g for g in train))) for k in range(langid.DIM)]
    assert np.abs(model.idf - idf).max() < 1e-5 and len(set(model.language)) > 1
    for r in langid.identify(docs, model).collect():
        text = raw[r.doc_id][1]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
            continue
        x = {k: math.log(1 + n) * idf[k] for k, n in plain_grams(text).items()}
        size = math.sqrt(sum(v * v for v in x.values())) or 1.0
        cosines = [sum(v * float(c[k]) for k, v in x.items()) / size for c in model.centre]
        best = max(cosines)
        assert abs(r.score - min(max(best, 0.0), 1.0)) < 1e-4
        assert r.lang_pred in {model.language[i] for i, c in enumerate(cosines) if c > best - 1e-4}
        floors = [float(model.floor[i]) for i, c in enumerate(cosines) if c > best - 1e-4]
        assert r.accepted in {best >= f for f in floors} or min(abs(best - f) for f in floors) < 1e-4
