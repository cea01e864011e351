"""The language model restated plainly: n-grams, family first, votes within it, and the machines' optimum."""

import math
from collections import Counter

import numpy as np
import pytest

from stenoflow.llm import language_id as L

FULL = 1 << 32


def plain_grams(text):
    """Hashed sequences of two to four bytes, A-Z as a-z."""
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    out = Counter()
    for size in (2, 3, 4):
        for i in range(size - 1, len(data)):
            code = data[i] | data[i - 1] << 8
            for k in range(2, size):
                code = (code * 0x01000193 + data[i - k]) % FULL
            mixed = (code + (size - 2) * 0x51ED27) * 0x9E3779B1 % FULL
            out[((mixed ^ mixed >> 15) * 0x85EBCA77 % FULL) >> 20] += 1
    return out


def plain_predict(model, text):
    grams = plain_grams(text)
    n = max(sum(grams.values()), 1)
    m = [sum(c * float(model.weights[g, k]) for g, c in grams.items()) / n + float(model.bias[k]) for k in range(model.weights.shape[1])]
    homes = [L.family_of(x) for x in model.languages]
    most = max(m[: len(model.families)])
    shares = [math.exp(x - most) for x in m[: len(model.families)]]
    family = max(range(len(shares)), key=lambda k: shares[k])
    votes = Counter()
    for k, (a, b) in enumerate(model.pairs):
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, m[len(model.families) + k]))))
        votes[a] += p
        votes[b] += 1 - p
    best, value = None, -1.0
    for k, home in enumerate(homes):
        if home == model.families[family]:
            rivals = homes.count(home) - 1
            share = votes[k] / rivals if rivals else 1.0
            if share > value:  # of equal votes the first language wins
                best, value = k, share
    return model.languages[best], shares[family] / sum(shares) * value


def test_predictions_equal_the_plain_rules(spark, docs):
    model = L.train(docs)
    assert model.pairs and len(model.families) > 1
    texts = [r.text for r in docs.orderBy("doc_id").limit(25).collect() if r.text] + ["a", "Zz", "ß É", "日本語", "9 a 9", "the de la und " * 3]
    df = spark.createDataFrame([(i, t[:3000]) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "12 !!")], "doc_id long, text string")
    got = {r.doc_id: r for r in L.predict(df, model).collect()}
    for i, t in enumerate(texts):
        lang, score = plain_predict(model, t[:3000])
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, rel=2e-3, abs=1e-6)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))


def test_ties():
    """Without a weight all families and all languages are equal, and the first ones win."""
    model = L.Model(["de", "en", "fr"], ["germanic", "romance"], np.zeros((L.DIMENSIONS, 3), np.float32), np.zeros(3), [(0, 1)], np.zeros(L.DIMENSIONS), 0.0, np.inf)
    best, score = model.predict(np.frombuffer(b"any text", np.uint8), np.array([0, 8]))
    assert model.languages[best[0]] == "de" and score[0] == pytest.approx(0.25)


def loss(x, y, weight, w, b):
    return float((weight * np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum() + 0.5e-4 * w @ w)


def test_machines_reach_the_optimum():
    """Squared hinge loss with a small ridge is convex: plain descent finds nothing better."""
    r = np.random.default_rng(3)
    for _ in range(4):
        x = r.normal(size=(60, 8))
        y = np.where(x @ r.normal(size=8) + 0.5 * r.normal(size=60) > 0.8, 1.0, -1.0)
        weight = L._balanced(y)
        assert weight[y > 0].sum() == pytest.approx(0.5) and weight[y < 0].sum() == pytest.approx(0.5)
        w, b = L._svm(x, y, weight, rounds=5_000)
        pw, pb = np.zeros(8), 0.0
        for _ in range(20_000):
            pull = -2 * weight * y * np.maximum(0, 1 - y * (x @ pw + pb))
            pw, pb = pw - 0.02 * (x.T @ pull + 1e-4 * pw), pb - 0.02 * pull.sum()
        assert loss(x, y, weight, w, b) <= loss(x, y, weight, pw, pb) * 1.02 + 1e-6
