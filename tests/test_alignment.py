import random

import pytest
from pyspark.sql import functions as F

from stenoflow.operators import align_exact, alignment, selection


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distances_to_prefixes():
    r = random.Random(3)
    for _ in range(300):
        a = "".join(r.choice("ab c") for _ in range(r.randint(0, 9)))
        b = "".join(r.choice("ab c") for _ in range(r.randint(0, 12)))
        cuts = sorted({r.randint(0, len(b)) for _ in range(3)})
        assert align_exact.distances(a, b, cuts) == [edit(a, b[:c]) for c in cuts]


def test_cer(spark):
    rows = [("", "abc"), ("abc", "abc"), ("ab", "xyzuvw"), ("häß", "has")]
    got = spark.createDataFrame(rows, "a string, b string").select(alignment.cer(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [1.0, 0.0, 3.0, pytest.approx(2 / 3)]


def passage(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n)]


def test_set_based_finds_a_perturbed_passage(spark):
    doc = passage(200, 1)
    heard = [w for i, w in enumerate(doc[60:90]) if i % 9]
    segs = spark.createDataFrame([(1, heard)], "seg long, stoks array<string>").withColumn("asr", F.array_join("stoks", " "))
    docs = spark.createDataFrame([(7, doc), (8, passage(150, 2)), (9, [])], "doc long, toks array<string>")
    paired = alignment.pairs(segs, docs)
    got = alignment.best(alignment.fine(alignment.coarse(paired)), paired).collect()
    assert len(got) == 1 and got[0]["doc"] == 7 and got[0]["stage"] == "region"
    text = " ".join(doc[got[0]["start"] : got[0]["end"]])
    brute = min(
        edit(" ".join(heard), " ".join(doc[s : s + n])) for s in range(50, 75) for n in range(15, 40)
    ) / len(" ".join(heard))
    assert got[0]["cer"] == pytest.approx(brute) and edit(" ".join(heard), text) / len(" ".join(heard)) == pytest.approx(brute)


def test_sequential_alignment_follows_the_cursor(spark):
    doc = passage(120, 5)
    rows = [("v", "t", i, " ".join(doc[i * 12 : i * 12 + 12]), " ".join(doc)) for i in range(8)]
    got = align_exact.align(spark.createDataFrame(rows, "video string, transcript string, seg_idx int, asr string, text string"))
    for r in got.orderBy("seg_idx").collect():
        assert (r["start_idx"], r["end_idx"], r["cer"], r["error"]) == (r["seg_idx"] * 12, r["seg_idx"] * 12 + 12, 0.0, None)


def test_sequential_alignment_of_empty_inputs(spark):
    rows = [("v", "t", 0, "", "a b c"), ("w", "t", 0, "a b", ""), ("x", "t", 0, None, None)]
    got = {r["video"]: r for r in align_exact.align(spark.createDataFrame(rows, "video string, transcript string, seg_idx int, asr string, text string")).collect()}
    assert got["v"]["cer"] == 1.0 and got["w"]["cer"] == 1.0 and all(r["error"] is None for r in got.values())


def test_selection_levels(spark):
    rows = [
        ("v", "t1", "txt", 0, 0.2, 1.0), ("v", "t1", "srt", 0, 0.2, 1.0), ("v", "t2", "txt", 0, 0.5, 1.0), ("v", "t3", "txt", 0, 1.0, 1.0), ("w", "t1", "txt", 0, None, 1.0),
    ]
    df = spark.createDataFrame(rows, "video string, transcript string, format string, seg_idx int, cer double, duration double")
    level1 = selection.best_format(df)
    assert {(r["transcript"], r["format"]) for r in level1.collect()} == {("t1", "srt"), ("t2", "txt")}
    pick = {s: {r["transcript"] for r in selection.select_transcripts(level1, s, 0.3).collect()} for s in selection.STRATEGIES}
    assert pick["best_only"] <= pick["threshold_all"] <= pick["force_all"] and pick["best_only"] == {"t1"}
    with pytest.raises(ValueError):
        selection.select_transcripts(level1, "all", 0.3)
    stats = {r["video"]: r for r in selection.alignment_stats(df).collect()}
    assert stats["w"]["median_cer"] == 0.0 and stats["w"]["skipped"] == 1


def restated(tokens, asr, cursor):
    """The search with every distance computed on its own."""
    n, w = len(tokens), max(len(asr.split()), 1)
    step = max(w // 2, 1)

    def cer(start, length):
        return edit(asr, " ".join(tokens[start : start + length])) / len(asr) if asr else 1.0

    def near(region):
        best, good = None, False
        for start in range(region - 15, region + 16):
            here = [(cer(start, k), k) for k in range(max(0, w - 15), w + 16) if start + k <= n] if start >= 0 else []
            if not here:
                continue
            c, k = min(here)
            if best is None or c < best[0]:
                best = (c, start, start + k)
            good = good or best[0] <= 0.05
            if good and c > 0.05:
                break
        return best

    def windows(at):
        forward, pos = [], at
        while pos < n:
            forward.append(min(pos, max(n - w, 0)))
            if pos + w > n:
                break
            pos += step
        backward, pos = [], at
        while pos > max(at - 250, 0):
            pos = max(pos - step, max(at - 250, 0))
            backward.append(pos)
        seen = []
        while forward or backward:
            turn, forward, backward = forward[:5] + backward[:1], forward[5:], backward[1:]
            for p in turn:
                c = cer(p, w)
                if c <= 0.3 and all(c < x for x, _ in seen):
                    return [p]
                seen.append((c, p))
        return [p for _, p in sorted(seen)[:3]]

    for at, limit in ((cursor, 0.3), (0, 0.45)):
        found = [m for m in map(near, windows(at)) if m and m[0] <= limit]
        if found:
            return min(found, key=lambda m: m[0])
    return near(cursor)


def test_sequential_search_equals_its_restatement():
    r = random.Random(12)
    for case in range(14):
        doc = [r.choice(["ä", "ße", "on", "и", "cd", "e"]) + r.choice("xyz") for _ in range(r.choice([0, 3, 20, 45, 103]))]
        width = r.choice([1, 4, 10, 22])
        at = r.randint(0, max(len(doc) - width, 0))
        heard = [w if r.random() < 0.85 else "um" for w in doc[at : at + width]] or ["nil"] * width
        if case % 5 == 4:
            heard = ["qq"] * width
        for cursor in {0, 7, 33, len(doc)}:
            asr, cursor = " ".join(heard), min(cursor, len(doc))
            got = align_exact.Aligner(doc).find(asr, cursor)
            assert (got and (pytest.approx(got[0]), *got[1:])) == restated(doc, asr, cursor)


def test_a_segment_longer_than_what_is_left_has_no_match(spark):
    rows = [("v", "t", i, "x " * 30, "a b c") for i in range(2)]
    got = align_exact.align(spark.createDataFrame(rows, "video string, transcript string, seg_idx int, asr string, text string")).collect()
    assert [(r["seg_idx"], r["start_idx"], r["cer"], r["error"]) for r in got] == [(0, None, None, None), (1, None, None, None)]
