"""Periodic runs against a plain search, and in time on long texts."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import pytest

from stenoflow.llm import runs


def plain_runs(w, least=6, exponent=4):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length, s = j - i + q, w[i : j + q]
            if j > i and length >= max(least, exponent * q) and all(s[p:] != s[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def texts(seed, number):
    rng = random.Random(seed)
    for _ in range(number):
        k, n = rng.choice([1, 2, 2, 3, 4]), rng.randrange(60)
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.6 and n:
            a, p = rng.randrange(n), 1 + rng.randrange(8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        yield w + [7] + w[-12:] * rng.randrange(1, 5) if rng.random() < 0.3 else w


def test_runs():
    for w in texts(5, 1500):
        assert runs.runs(w) == plain_runs(w)


@pytest.mark.parametrize("least,exponent", [(6, 2), (1, 2), (9, 3)])
def test_other_bounds(least, exponent):
    """Stretches shorter than the sorted prefix make no run at these bounds but with few words."""
    for w in texts(6, 300):
        want = [r for r in plain_runs(w, least, exponent) if r[1] - r[2] >= runs.PREFIX]
        assert [r for r in runs.runs(w, least, exponent) if r[1] - r[2] >= runs.PREFIX] == want


def test_long_texts():
    rng = random.Random(7)
    cases = {
        "one word": ["a"] * 100_000, "period of seven": list("abcdefg") * 10_000, "two words": [rng.choice("ab") for _ in range(50_000)],
        "common phrase": [w for i in range(15_000) for w in ("a", "b", "c", "d", "e", str(i))],
        "phrase in different places": [w for i in range(10_000) for w in (str(-i), *"abcdefghij", str(i))],
    }
    for name, w in cases.items():
        begun = time.time()
        runs._read(" ".join(w))
        assert time.time() - begun < 20, name


def test_detect(spark, odd):
    rows = runs.detect(odd, to=("n", "found")).collect()
    assert len(rows) == odd.count() and all(r.p == "clash" for r in rows)
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        if len(w) < 1000:
            assert [tuple(x) for x in r.n] == plain_runs(w)
            assert r.found == " ".join(w) or r.n
    long = next(r for r in rows if r.doc_id == 5)
    assert [tuple(x) for x in long.n] == [(0, 30_000, 1)] and long.found.startswith("word token")


def test_query(spark, docs):
    want = {}
    for d in docs.collect():
        w, h = re.findall(r"[^\x20\x09-\x0D]+", d.text or ""), zlib.crc32(str(d.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        elif n > 400:
            continue
        found = plain_runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[d.doc_id] = (len(found), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
                          sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    got = {r.doc_id: tuple(r)[1:] for r in runs.op12_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == docs.count() and {k: got[k] for k in want} == want and any(v[0] for v in want.values())
