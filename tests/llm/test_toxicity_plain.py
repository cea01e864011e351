"""The toxicity model restated plainly: lifted features, noisy-or steps, scores and offending sentences."""

import math
import random
import re
from collections import Counter

import pytest

from stenoflow.llm import toxicity


def plain_sentences(text):
    """(start, end, features of its words) of every sentence."""
    out, last = [], None
    for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010ffff]+", text):
        word = re.sub("[A-Z]", lambda c: c.group().lower(), m.group()).encode()
        found = [(0, word)] + [(k, word[:k]) for k in (4, 5, 6, 7) if len(word) > k]
        if last is None or re.search(r"[.!?\n]", text[last : m.start()]):
            out.append([m.start(), m.end(), []])
        out[-1][1] = last = m.end()
        out[-1][2].extend(found)
    return out


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def noisy_or(ps):
    return 1 - math.exp(sum(math.log1p(-min(p, 1 - 1e-12)) for p in ps))


def plain_fit(docs, names, rounds=300, rate=0.15, l1=3e-4):
    """Adam on the noisy-or likelihood; weights stay at or above zero."""
    w, b = dict.fromkeys(names, 0.5), -9.0
    first, second = Counter(), Counter()
    for t in range(1, rounds + 1):
        g, gb = dict.fromkeys(names, l1), 0.0
        for sentences, label in docs:
            p = [sigmoid(b + sum(w[f] for f in s)) for s in sentences]
            whole = min(max(noisy_or(p), 1e-9), 1 - 1e-9)
            for s, q in zip(sentences, p, strict=True):
                blame = q * (-(1 - whole) / whole if label else 1.0) / len(docs)
                gb += blame
                for f in s:
                    g[f] += blame
        size = rate / (1 + t / 100)
        for f, x in [*g.items(), ("bias", gb)]:
            first[f] = 0.9 * first[f] + 0.1 * x
            second[f] = 0.99 * second[f] + 0.01 * x * x
            step = size * (first[f] / (1 - 0.9**t)) / (math.sqrt(second[f] / (1 - 0.99**t)) + 1e-7)
            if f == "bias":
                b -= step
            else:
                w[f] = max(0.0, w[f] - step)
    return w, b


def plain_train(rows):
    n = Counter(y for _, y in rows)
    holds = {y: Counter(f for t, z in rows if z == y for f in {f for s in plain_sentences(t) for f in s[2]}) for y in (0, 1)}
    need = min(toxicity.MIN_DOCUMENTS, max(1, int(toxicity.MIN_SHARE * n[1])))
    kept = {f for f, c in holds[1].items() if c >= need and (c / n[1]) / ((holds[0][f] + 0.5) / n[0]) >= toxicity.LEAST_LIFT}
    return plain_fit([([[f for f in s[2] if f in kept] for s in plain_sentences(t)], y) for t, y in rows], kept)


def test_train_and_score_equal_the_plain_rules(spark):
    r = random.Random(6)
    plain = "the report says that trade grew again in märz and nobody was hurt by it".split()
    bad = "idiotic idiots stupidly stupid schmutzig loser".split()
    rows = []
    for k in range(50):
        said = [" ".join(r.choices(plain, k=r.randint(1, 7))) for _ in range(r.randint(1, 4))]
        if k % 2:
            at = r.randrange(len(said))
            said[at] = f"{said[at]} {r.choice(bad)} {r.choice(bad)}"
        rows.append((r.choice([". ", "! ", "\n", "?? "]).join(said), k % 2))
    docs = [(i, t) for i, (t, _) in enumerate(rows)]
    unseen = [(900, "STUPID ünd idiots. The trade grew! losers"), (901, ""), (902, None), (903, "no marks and no words of that kind"), (904, "...?!"), (905, "loser")]
    df = spark.createDataFrame(docs + unseen, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, label int")
    got = {x.doc_id: x for x in toxicity.score(df, toxicity.train(df, labels)).collect()}
    weight, bias = plain_train(rows)
    assert sum(w > 0 for w in weight.values()) > 3
    for i, text in docs + unseen:
        spans = [(s, e, sigmoid(bias + sum(weight.get(f, 0.0) for f in found))) for s, e, found in plain_sentences(text or "")]
        whole = noisy_or(p for *_, p in spans)
        assert got[i].score == pytest.approx(whole, rel=1e-6, abs=1e-9)
        assert got[i].predicted == (whole >= toxicity.THRESHOLD)
        want = [x for x in spans if x[2] >= toxicity.SENTENCE_THRESHOLD]
        assert [(x.start, x.end) for x in got[i].offending] == [x[:2] for x in want]
        assert [x.p for x in got[i].offending] == pytest.approx([x[2] for x in want], rel=1e-6)
    assert got[901].score == got[902].score == 0 and got[900].score > 0.5
