"""The bounded samples of labelled rows, with keys that many rows share."""

import pytest
from pyspark.sql import functions as F

from stenoflow.llm import common as C
from stenoflow.llm import quality, toxicity


@pytest.fixture(scope="module")
def shared(spark):
    # key 7 holds most rows: copies of one text, and texts of their own
    return spark.range(6000).select(
        F.when(F.col("id") < 5000, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 3000, F.lit("one text that is often repeated"))
        .when(F.col("id") % 2 == 0, F.concat(F.lit("a good report on trade, number "), "id"))
        .otherwise(F.concat(F.lit("!!! WIN free stuff "), "id")).alias("text"),
    )


def labels_of(df):
    return df.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("label"))


def test_labels_count_once_and_only_0_and_1(spark):
    rows = [(1, 0), (1, 0), (1, 1), (2, None), (3, 2), (None, 1)]
    got = C.known_labels(spark.createDataFrame(rows, "key long, y int"), "key", "y")
    assert sorted(map(tuple, got.collect())) == [(1, 0), (1, 1)]


def test_rows_under_a_shared_key_are_bounded(spark, shared):
    drawn = C.known_labels(labels_of(shared), "doc_id", "label").withColumn("o", F.lit(0.5))
    every = C.drawn_rows(shared, drawn, 6000, key="doc_id", text="text")
    assert every.count() == 6000
    some = C.drawn_rows(shared, drawn, 600, key="doc_id", text="text")
    rows = sorted(map(tuple, some.collect()), key=str)
    assert 500 < len(rows) < 700 and len(set(rows)) == len(rows)
    assert {(r.k, r.label) for r in every.collect()} >= {r[:2] for r in rows}
    # the draw depends on the rows alone
    again = C.drawn_rows(shared.repartition(3, "text"), drawn, 600, key="doc_id", text="text")
    assert sorted(map(tuple, again.collect()), key=str) == rows


def test_training_under_a_shared_key_is_bounded_and_repeatable(spark, shared, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 200)
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, *a, **k: seen.append(len(rows)) or fit(rows, *a, **k))
    hot = labels_of(shared).where("doc_id = 7").union(labels_of(shared).where("doc_id = 7"))
    model = quality.train(shared, hot)
    assert 300 < seen[0] < 500
    assert (quality.train(shared.repartition(5), hot).weights == model.weights).all()
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 100)
    bags = []
    train = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda rows, *a, **k: bags.append(len(rows)) or train(rows, *a, **k))
    toxicity.train(shared, hot)
    assert 300 < bags[0] < 500
