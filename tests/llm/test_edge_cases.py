"""Every operator on odd rows, on an empty table, and on one row."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stenoflow.llm import bytesets as B
from stenoflow.llm import decontaminate, html_text, jaccard_join, language_id, merkle, mixing, quality, runs, secrets, sharding, token_counts, topk_search, toxicity

MODEL = __import__("public_tokenizers").path("piece_bpe_32k.model")


def labels(df):
    return df.select("doc_id", (F.col("doc_id") % 2).alias("label"))


def bench(df):
    return df.sparkSession.createDataFrame([(1, "plain text of a page"), (2, None), (None, "x"), (3, ""), (1, "plain text of a page"), (4, "!!")], "item_id long, text string")


CASES = {
    "secrets": lambda d: secrets.scan(d),
    "decontaminate": lambda d: decontaminate.find(d, bench(d)),
    "clean": lambda d: decontaminate.clean(d, bench(d)),
    "language": lambda d: language_id.predict(d, language_id.train(d)),
    "plan": lambda d: mixing.plan(d),
    "mix": lambda d: mixing.mix(d),
    "tokens": lambda d: token_counts.count_tokens(d, MODEL),
    "search": lambda d: topk_search.search(d, d.where("doc_id > 4"), k=2),
    "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels(d))),
    "components": lambda d: jaccard_join.components(d),
    "keep_one": lambda d: jaccard_join.keep_one(d),
    "html": lambda d: html_text.main_text(d, page="text", to=("body", "n_body")),
    "manifest": lambda d: merkle.manifest(d, merkle.FIELDS),
    "runs": lambda d: runs.detect(d),
    "shards": lambda d: sharding.assign(d),
    "quality": lambda d: quality.score(d, quality.train(d, labels(d))),
}
RESULTS_ALONE = {"plan", "search", "components", "manifest", "shards"}
SAME_ROWS = {"secrets", "decontaminate", "language", "plan", "tokens", "toxicity", "components", "html", "quality", "manifest", "runs", "shards"}


@pytest.mark.parametrize("name", CASES)
def test_odd_rows(odd, name):
    got = CASES[name](odd)
    rows = got.collect()
    assert len({c.lower() for c in got.columns}) == len(got.columns)
    if name not in RESULTS_ALONE:
        # no column of the caller's is lost or changed
        assert set(odd.columns) <= set(got.columns)
        assert all(r[c] == "clash" for r in rows for c in ("n", "p", "q", "at", "__p", "__k", "__t", "__lang", "__hit", "__tox", "__n", "__found"))
    if name in SAME_ROWS:
        assert len(rows) == odd.count()
    again = CASES[name](odd.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("name", CASES)
def test_empty_table(odd, name):
    assert CASES[name](odd.where("false")).collect() == []


def test_defined_results(odd):
    lang = {r["doc_id"]: r for r in CASES["language"](odd).where("doc_id in (2, 3, 4, 7)").collect()}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in lang.values())
    tokens = {r["doc_id"]: r["n_tokens"] for r in CASES["tokens"](odd).where("doc_id in (2, 3)").collect()}
    assert tokens == {2: 0, 3: 0}
    comp = [(r["key"], r["n_shingles"], r["component"]) for r in CASES["components"](odd).collect()]
    assert comp.count((1, 1, 1)) == 2 and (2, 0, 2) in comp and (3, 0, 3) in comp and (4, 0, 4) in comp
    assert {r["doc_id"] for r in CASES["decontaminate"](odd).where("size(contamination) > 0").collect()} == {1}
    plan = CASES["plan"](odd).collect()
    assert all(r["taken"] == 0 for r in plan if r["size"] == 0) and all(r["taken"] <= 3 * r["size"] for r in plan)


def test_items_of_any_id_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "We saw the art of war, again."), (2, "a party")], "doc_id long, text string")
    items = spark.createDataFrame([("b-1", "The art of war"), (None, "art of"), ("c", "art")], "item_id string, text string")
    got = {r["doc_id"]: sorted(str(c["item"]) for c in r["contamination"]) for r in decontaminate.find(docs, items).collect()}
    assert got == {1: ["None", "b-1", "c"], 2: []}
    assert [r["doc_id"] for r in decontaminate.clean(docs, items.where("item_id is null")).collect()] == [2]


def test_toxic_offsets_are_code_points(spark):
    text = "Grüße an alle. Dies ist übel gesagt! Schön."
    model = toxicity.Model(toxicity.Lookup(toxicity.sentences(*B.utf8(pa.array(["gesagt"])))[0][:, 0]), np.array([20.0]), -9.0)
    got = toxicity.score(spark.createDataFrame([(text,), ("é",), (None,)], "text string"), model).collect()
    spans = {r["text"]: [(s["start"], s["end"]) for s in r["offending"]] for r in got}
    a = text.index("Dies")
    assert spans == {text: [(a, text.index("!"))], "é": [], None: []}


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("rows", ["true", "false"])
def test_pipeline_stages_on_odd_rows(spark, odd, tmp_path, stage, rows):
    bench(odd).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = dict(corpus_pipeline.STAGES)[stage](spark, odd.where(rows), str(tmp_path))
    count = got.count()
    assert count == 0 if rows == "false" else count > 0
    assert stage == "mixing" or got.columns == odd.columns
