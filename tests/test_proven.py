"""Sweeps of bit vectors, and alignment whose misses are proven, against brute force."""

import random
from functools import partial

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stenoflow.operators import align_exact, alignment, proven
from stenoflow.operators.sweep import Pattern, Patterns
from tests.test_alignment import edit, passage


def test_windows_and_bands():
    r = random.Random(1)
    for _ in range(400):
        a = "".join(r.choice("abcß") for _ in range(r.randrange(20)))
        texts = ["".join(r.choice("abcd") for _ in range(r.randrange(25))) for _ in range(r.randrange(1, 6))]
        assert Pattern(a).windows(texts) == [edit(a, t) for t in texts]
        text, starts = "".join(r.choice("abßd") for _ in range(40)), sorted(r.sample(range(30), 4))
        ends = [sorted(r.randrange(s, 41) for _ in range(3)) for s in starts]
        assert Pattern(a).band(text, starts, ends) == [[edit(a, text[s:e]) for e in es] for s, es in zip(starts, ends, strict=True)]


def test_ends_of_many_patterns():
    r = random.Random(2)
    for _ in range(150):
        patterns = ["".join(r.choice("abc") for _ in range(r.randrange(1, 15))) for _ in range(r.randrange(1, 5))]
        text, limits = "".join(r.choice("abcd") for _ in range(40)), [r.randrange(len(p) + 1) for p in patterns]
        got = Patterns(patterns).ends(text, limits)
        for p, limit, ends in zip(patterns, limits, got, strict=True):
            assert ends == [e for e in range(len(text) + 1) if min(edit(p, text[s:e]) for s in range(e + 1)) <= limit]


def test_fine_equals_all_windows():
    r = random.Random(3)
    for _ in range(40):
        doc = passage(r.randrange(1, 30), r.random())
        heard = [w for w in doc[5:15] if r.random() < 0.8] or ["x"]
        asr, first, starts = " ".join(heard), r.randrange(3), r.randrange(1, 12)
        lengths = range(max(len(heard) - 3, 1), len(heard) + 4)
        every = [(edit(asr, " ".join(doc[s : s + k])), s, k) for s in range(min(starts, len(doc))) for k in lengths if s + k <= len(doc)]
        best = min((x for x in every if x[0] <= -(-len(asr) * 45 // 100)), default=None)
        got = alignment.least(asr, " ".join(doc), first, starts, lengths)
        assert got == (best and {"start": first + best[1], "end": first + best[1] + best[2], "cer": best[0] / len(asr)})


def worn(words, r):
    """Every word changed by a letter: no n-gram of words is left."""
    return [w[:k] + "#" + w[k + 1 :] for w in words for k in [r.randrange(len(w))]]


def brute(asr, n, doc):
    every = ((edit(asr, " ".join(doc[s : s + k])), s, s + k) for k in range(max(n - 15, 1), n + 16) for s in range(len(doc) - k + 1))
    best = min(every, default=None)
    return best if best and best[0] <= len(asr) * 0.45 else None


def test_no_match_is_missed(spark):
    r = random.Random(8)
    docs = {7: passage(60, 1), 8: passage(50, 2), 9: [], 10: passage(45, 4)}
    heard = {1: docs[7][20:32], 2: worn(docs[8][10:22], r), 3: passage(12, 77), 4: worn(docs[10][-9:], r), 5: [], 6: worn(docs[7][:5], r)}
    segs = spark.createDataFrame(list(heard.items()), "seg long, stoks array<string>").withColumn("asr", F.array_join("stoks", " "))
    transcripts = spark.createDataFrame([*docs.items(), (11, None)], "doc long, toks array<string>")
    got = proven.match(segs, transcripts).collect()
    want = {(s, d): brute(" ".join(h), len(h), t) for s, h in heard.items() for d, t in docs.items() if h}
    found = {(x.seg, x.doc): x for x in got if x.doc is not None}
    assert {s for s, _ in found} == {s for (s, _), b in want.items() if b}
    assert {x.seg for x in got if x.stage == "unmatched"} == set(heard) - {s for s, _ in found}
    assert {x.stage for k, x in found.items() if k[0] != 1} == {"swept"} and found[1, 7].stage == "region" and found[1, 7].cer == 0
    for k, x in found.items():
        asr = " ".join(heard[k[0]])
        assert (round(x.cer * len(asr)), x.start, x.end) == want[k]
    # every pair, by the sweep alone
    every = {(x.seg, x.doc): (round(x.cer * len(" ".join(heard[x.seg]))), x.start, x.end) for x in proven.search_all(segs, transcripts).collect()}
    assert every == {k: b for k, b in want.items() if b}
    assert {x.stage for x in proven.match(segs, transcripts.limit(0)).collect()} == {"unmatched"}


def test_hot_grams_are_no_seeds(spark):
    formula = ["so", "help", "me", "god", "amen"]
    docs = [(i, passage(3, i) + formula) for i in range(40)]
    segs = spark.createDataFrame([(1, docs[5][1])], "seg long, stoks array<string>")
    transcripts = spark.createDataFrame(docs, "doc long, toks array<string>")
    grams = {x.gram for x in proven.rare_grams(segs, transcripts, hot=39).collect()}
    assert "help me god amen" not in grams and len(grams) == 3
    assert {x.gram for x in proven.rare_grams(segs, transcripts, seeds=2).collect()} == {" ".join(docs[5][1][i : i + 4]) for i in (0, 1)}


def test_pairs_beyond_the_seeds_are_found(spark, monkeypatch):
    r = random.Random(4)
    monkeypatch.setattr(proven, "rare_grams", partial(proven.rare_grams, hot=2, seeds=3))
    formula = passage(14, 50)
    docs = {i: passage(9, i) + formula + passage(5, i + 30) for i in range(6)}
    docs[7] = passage(6, 7) + worn(docs[0][:20], r) + passage(6, 37)
    segs = spark.createDataFrame([(1, docs[0][3:21]), (2, formula)], "seg long, stoks array<string>").withColumn("asr", F.array_join("stoks", " "))
    transcripts = spark.createDataFrame(list(docs.items()), "doc long, toks array<string>")
    got = {(x.seg, x.doc): x for x in proven.match(segs, transcripts).collect()}
    heard = {1: docs[0][3:21], 2: formula}
    want = {(s, d): brute(" ".join(h), len(h), t) for s, h in heard.items() for d, t in docs.items()}
    assert {k: (round(x.cer * len(" ".join(heard[k[0]]))), x.start, x.end) for k, x in got.items()} == {k: b for k, b in want.items() if b}
    # a segment that is matched at its seeds in one text is found in those that share only hot n-grams with it, or none
    assert got[1, 0].stage == "region" and {got[1, d].stage for d in (1, 2, 3, 4, 5, 7)} == {"swept"}


def test_a_failing_segment_keeps_what_was_done(monkeypatch):
    doc = passage(60, 3)
    part = pd.DataFrame({"video": "v", "transcript": "t", "seg_idx": [0, 1, 2], "asr": [" ".join(doc[:12]), "broken", " ".join(doc[24:36])], "text": [" ".join(doc), None, None]})
    find = align_exact.Aligner.find
    monkeypatch.setattr(align_exact.Aligner, "find", lambda self, asr, cursor: 1 / 0 if asr == "broken" else find(self, asr, cursor))
    rows = align_exact._align(part).to_dict("records")
    assert [(x["seg_idx"], x["start_idx"]) for x in rows[:1]] == [(0, 0)] and len(rows) == 2
    assert rows[1]["seg_idx"] == 1 and "ZeroDivisionError" in rows[1]["error"]


def test_windows_in_groups():
    assert list(proven._near([1, 2, 9, 10, 30], 7)) == [[1, 2, 9, 10], [30]]
    assert proven.windows("abc", "", 1, [0]) is None
    with pytest.raises(StopIteration):
        next(proven._blocks([], 5))
