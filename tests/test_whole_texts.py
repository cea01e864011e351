"""Queries that see every language and whole Unicode texts, against brute force."""

import hashlib
import random
import re
import statistics

import pytest

from stenoflow.plans import alignment, speech  # noqa: F401
from stenoflow.plans.registry import QUERIES
from tests.test_alignment import edit


def passage(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("aeñßéüоя") for _ in range(r.randint(2, 5))) for _ in range(n)]


def heard(words):
    return ["um" if i % 11 == 0 else w for i, w in enumerate(words, 1) if i % 7]


ITEMS = {1: passage(22, 1), 2: passage(22, 2), 3: passage(22, 3)}
DOCS = {
    10: ("de", passage(30, 4) + ITEMS[1] + passage(10, 5)),
    11: (None, passage(9, 6) + ITEMS[2] + passage(25, 7)),
    12: ("es", passage(40, 8)),
}
EXPANDED = {10: "de été", 11: "été er", 12: "éde"}


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("whole"))
    items = [(k, " ".join(v)) for k, v in ITEMS.items()]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    docs = [(k, " ".join(v), lang) for k, (lang, v) in DOCS.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{top}/documents.parquet")
    return top


def best(asr, doc):
    return min(edit(asr, " ".join(doc[s : s + n])) for s in range(len(doc)) for n in range(12, 25)) / len(asr)


def test_best_matches_of_all_languages(spark, data):
    got = {(r["seg"], r["doc"]): r for r in QUERIES["align_best_full"](spark, data).collect()}
    assert set(got) == {(1, 10), (2, 11), (3, None)} and got[3, None]["stage"] == "unmatched"
    for seg, doc in ((1, 10), (2, 11)):
        asr = " ".join(heard(ITEMS[seg]))
        r = got[seg, doc]
        assert r["cer"] == pytest.approx(best(asr, DOCS[doc][1]), abs=1e-6) and r["stage"] == "region"
        assert edit(asr, " ".join(DOCS[doc][1][r["start"] : r["end"]])) / len(asr) == pytest.approx(r["cer"], abs=1e-6)


@pytest.mark.parametrize("name", ["cer_pairs_full", "align_coarse_full", "align_fine_full"])
def test_pairs_of_all_languages(spark, data, name):
    rows = QUERIES[name](spark, data).collect()
    assert {(r["seg"], r["doc"]) for r in rows} == {(1, 10), (2, 11)}
    if name == "cer_pairs_full":
        for r in rows:
            h = heard(ITEMS[r["seg"]])
            text = " ".join(DOCS[r["doc"]][1][r["start"] : r["start"] + len(h)])
            assert r["cer"] == pytest.approx(edit(" ".join(h), text) / len(" ".join(h)), abs=1e-6)


def test_sequential_alignment_of_all_languages(spark, data):
    rows = QUERIES["align_exact"](spark, data).collect()
    assert {(r["video"], r["transcript"]) for r in rows} == {("v1", "10"), ("v2", "11")}
    for r in rows:
        h = heard(ITEMS[int(r["video"][1:])])[r["seg_idx"] * 12 :][:12]
        text = " ".join(DOCS[int(r["transcript"])][1][r["start_idx"] : r["end_idx"]])
        assert r["cer"] == pytest.approx(edit(" ".join(h), text) / len(" ".join(h)), abs=1e-6)
    # the selection takes the median of each pair's segments, and the best pair of a video within the bound
    cers = {}
    for r in rows:
        cers.setdefault((r["video"], r["transcript"]), []).append(r["cer"])
    want = {(v, t, "txt", round(statistics.median(c), 4), len(c)) for (v, t), c in cers.items() if statistics.median(c) <= 0.8}
    got = {(r["video"], r["transcript"], r["format"], round(r["cer"], 4), r["segments"]) for r in QUERIES["align_pipeline"](spark, data).collect()}
    assert got == want and len(want) == 2


def test_word_errors_of_whole_texts(spark, data):
    r = QUERIES["corpus_wer_full"](spark, data).collect()[0]
    assert (r["pairs"], r["words"]) == (3, 66)
    assert r["edits"] == sum(edit(heard(v), v) for v in ITEMS.values())


def test_abbreviations_in_whole_texts(spark, data, tmp_path):
    rows = [(k, v) for k, v in EXPANDED.items()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["expanded"] for r in QUERIES["abbrev_expand_full"](spark, str(tmp_path)).collect()}
    want = {k: re.sub(r"\bde\b", "deutsch", re.sub(r"\ber\b", "error", v)) for k, v in EXPANDED.items()}
    assert got == {k: hashlib.md5(v.encode()).hexdigest() for k, v in want.items()}
