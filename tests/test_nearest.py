"""Bounds of distances, the best windows by few of them, and the texts that share n-grams."""

import random

import pytest
from pyspark.sql import functions as F

from stenoflow.functions import text as X
from stenoflow.operators import alignment, sweep
from stenoflow.operators.sweep import Pattern
from tests.test_alignment import edit


def test_least_distances_of_all_ends(monkeypatch):
    monkeypatch.setattr(sweep, "PART", 7)
    monkeypatch.setattr(sweep, "PARTS", 3)
    monkeypatch.setattr(sweep, "LEAST_PART", 4)
    r = random.Random(4)
    word = lambda n: "".join(r.choice("ab ü\U0001f600") for _ in range(n))
    for _ in range(60):
        some, text = [word(r.choice([1, 3, 7, 8, 9])) for _ in range(r.randint(1, 3))], word(r.choice([0, 1, 9, 50]))
        want = [[min(edit(a, text[s:e]) for s in range(e + 1)) for e in range(len(text) + 1)] for a in some]
        assert [row.tolist() for row in sweep.least([Pattern(a) for a in some], text)] == want
        assert [Pattern(a).to_ends(text, range(len(text) + 1), free=True) for a in some] == want
        assert [Pattern(a).to_ends(text, range(len(text) + 1)) for a in some] == [[edit(a, text[:e]) for e in range(len(text) + 1)] for a in some]


@pytest.mark.parametrize("few", [0, 12])
def test_the_best_windows_are_among_the_nearest(monkeypatch, few):
    monkeypatch.setattr(sweep, "FEW_ENDS", few)
    r = random.Random(7)
    for _ in range(150):
        doc = ["".join(r.choice("abc") for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 14))]
        at, lengths = range(r.randint(1, len(doc))), range(1, r.randint(2, 6))
        asr = " ".join(r.choice(doc) for _ in range(r.randint(1, 5)))
        got = alignment.least(asr, " ".join(doc), 3, len(at), lengths)
        d, s, e = min((edit(asr, " ".join(doc[s : s + k])), s, s + k) for s in at for k in lengths if s + k <= len(doc))
        limit = -(-len(asr) * 45 // 100)
        assert got == ({"start": 3 + s, "end": 3 + e, "cer": d / len(asr)} if d <= limit else None)


def test_near_texts_by_their_words_and_by_hashes(spark, monkeypatch):
    segs = spark.createDataFrame([(1, "a b c d e f".split()), (2, ["x"]), (3, None)], "seg int, stoks array<string>").withColumn("asr", F.array_join("stoks", " "))
    texts = [(60, " q a\u00a0b\x1cc\td r"), (61, "f e d c b a"), (62, None), (63, ""), (64, "c  d\u3000e\nf"), (65, "a b c"), (65, "b c d e"), (66, "ab c d e")]
    docs = spark.createDataFrame(texts, "doc int, text string").withColumn("toks", X.words(F.col("text")))
    want = [(60, "q a b c d r".split()), (64, "c d e f".split()), (65, "a b c".split()), (65, "b c d e".split())]
    for most in (100, 2):
        monkeypatch.setattr(alignment, "NEAR_GRAMS", most)
        for form in (docs, docs.drop("text")):
            assert sorted(map(tuple, alignment.nearby(segs, form).select("doc", "toks").collect())) == want


def test_words_are_split_as_python_does(spark):
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c <= 0xDFFF]
    text = "".join(f"a{chr(c)}b " for c in points)
    assert spark.createDataFrame([(text,)], "t string").select(X.words(F.col("t"))).first()[0] == text.split()
