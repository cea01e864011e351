"""Numbers of links against all pairs, with copies, families of near copies and hot n-grams."""

import random
import re

import pytest

from stenoflow.llm import jaccard_join as J

from .test_brute_force import jaccard_components


def plain(rows):
    split, lower = re.compile(r"[^\x20\x09-\x0d]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = split.findall((t or "").translate(lower))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                links[i] += 1
                links[j] += 1
    return links


@pytest.mark.parametrize("hot", [10_000, 7])
def test_links_within_components(spark, monkeypatch, hot):
    monkeypatch.setattr(J, "HOT_ROWS", hot)
    r = random.Random(8)
    rows = []
    for family in range(5):
        base = [f"f{family}w{r.randrange(60)}" for _ in range(60)]
        for _ in range(14):
            words = list(base)
            for _ in range(r.randrange(4)):
                words[r.randrange(60)] = f"x{r.randrange(900)}"
            rows += [" ".join(words)] * r.choice([1, 1, 1, 4])
    rows += ["", None, " \n", "one two", "ONE two", "alone in this corpus with seven words"]
    rows = list(enumerate(rows))
    r.shuffle(rows)
    got = {x.key: x for x in J.links(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want = jaccard_components(rows)
    assert {k: (x.n_shingles, x.component) for k, x in got.items()} == want
    counted = plain(rows)
    assert {k: x.n_links for k, x in got.items()} == {k: n for (k, _), n in zip(rows, counted, strict=True)}
    # families hold links between different texts that components does not need
    assert sum(counted) > 500


def test_links_of_odd_rows(spark, odd):
    got = J.links(odd).collect()
    assert len(got) == odd.count()
    assert sorted((x.key, x.n_links) for x in got if x.key is not None and x.n_links) == [(1, 1), (1, 1)]
    assert J.links(odd.limit(0)).collect() == []
