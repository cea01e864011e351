"""The quality model restated plainly: follow-the-regularised-leader steps, and the dot product."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from stenoflow.llm import quality


def plain_fit(rows, alpha, beta, l1, l2, epochs):
    z, s = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(s[i])) / alpha + l2)

    for _ in range(epochs):
        for values, label in rows:
            x = {i: v * quality.SCALE for i, v in values.items()} | {"bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - label) * x[i]
                sigma = (math.sqrt(s[i] + g * g) - math.sqrt(s[i])) / alpha
                z[i] += g - sigma * w[i]
                s[i] += g * g
    return weight


def bag(text):
    data = np.frombuffer(text.encode(), np.uint8)
    ids, _ = quality.features(data, np.array([0, len(data)]))
    found = Counter(ids.ravel().tolist())
    n = sum(found.values())
    return {i: c / n for i, c in sorted(found.items())}


def test_fit_and_score_equal_the_plain_rules():
    r = random.Random(4)
    good, bad = "the market rose after a long report on trade".split(), "click HERE now win win $$$ 100% free".split()
    rows = [(" ".join(r.choices(good if k % 2 else bad, k=r.randint(1, 12))), k % 2) for k in range(40)]
    bags = [(bag(t), y) for t, y in rows]
    given = {"alpha": 0.4, "beta": 1.2, "l1": 0.03, "l2": 0.6, "epochs": 3}
    arrays = [(np.array(list(b), np.int32), np.array(list(b.values())), y) for b, y in bags]
    model, weight = quality.fit(arrays, **given), plain_fit(bags, **given)
    assert model.bias == pytest.approx(weight("bias"))
    seen = {i for b, _ in bags for i in b}
    assert {i for i in seen if model.weights[i]} == {i for i in seen if weight(i)} != set()
    texts = [t for t, _ in rows] + ["", "unseen wörds 中文"]
    data, ends = "".join(texts).encode(), np.cumsum([0, *(len(t.encode()) for t in texts)])
    got = model.score(np.frombuffer(data, np.uint8), ends)
    for t, p in zip(texts, got, strict=True):
        value = weight("bias") + quality.SCALE * sum(v * weight(i) for i, v in bag(t).items())
        assert p == pytest.approx(1 / (1 + math.exp(-value)), rel=1e-4)
