"""The sequential search compares few windows and finds what a comparison of all of them finds."""

import random

import pytest

from stenoflow.operators import align_exact
from stenoflow.operators.sweep import Pattern
from tests.test_alignment import passage, restated


def test_a_long_transcript_is_searched_with_few_comparisons(monkeypatch):
    compared = []
    windows, band = Pattern.windows, Pattern.band
    monkeypatch.setattr(Pattern, "windows", lambda p, texts: compared.extend(texts) or windows(p, texts))
    monkeypatch.setattr(Pattern, "band", lambda p, *a: compared.extend(a[1]) or band(p, *a))
    doc = passage(3_000, 9)
    heard = ["um" if i % 5 == 3 else w for i, w in enumerate(doc[2_500:2_512])]
    got = align_exact.Aligner(doc).find(" ".join(heard), 0)
    assert got[1:] == (2_500, 2_512) and len(compared) < 60  # 500 windows lie before it


def test_searches_of_repeating_words_equal_their_restatement():
    r = random.Random(21)
    for case in range(24):
        doc = [r.choice(["on", "cd", "e", "ko"]) + r.choice(["", "x"]) for _ in range(r.choice([12, 40, 90]))]
        width = r.choice([2, 5, 12])
        at = r.randint(0, len(doc) - width)
        heard = [w if r.random() < 0.7 else r.choice(["um", w + "z"]) for w in doc[at : at + width]]
        for cursor in (0, len(doc) // 2):
            got = align_exact.Aligner(doc, coming=["on e", ""]).find(" ".join(heard), cursor)
            assert (got and (pytest.approx(got[0]), *got[1:])) == restated(doc, " ".join(heard), cursor), case
