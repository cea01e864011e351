"""Held-out figures of the trained models, and the pipeline."""

import corpus_pipeline
from pyspark.sql import functions as F

from stenoflow.llm import language_id, quality, toxicity

DATA = "/root/testdata/sf0.01"


def test_language(spark):
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    got = language_id.op3_language_id(spark, DATA).join(truth, "doc_id").where("held_out")
    n, right = got.count(), got.where("lang = lang_pred").count()
    assert right >= 0.98 * n and got.where("score < 0 or score > 1").count() == 0


def held_out(df, labels, column):
    rows = df.join(labels.select("doc_id", F.col(column).alias("y")), "doc_id").where("held_out").collect()
    pos, neg = [r["score"] for r in rows if r["y"] == 1], [r["score"] for r in rows if r["y"] == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg)), rows


def test_quality(spark):
    auc, _ = held_out(quality.op10_quality(spark, DATA), spark.read.parquet(f"{DATA}/labels.parquet"), "quality")
    assert auc >= 0.95


def test_toxicity(spark):
    data = DATA.replace("0.01", "0.1")
    auc, rows = held_out(toxicity.op7_toxicity(spark, data), spark.read.parquet(f"{data}/labels.parquet"), "toxic")
    assert auc >= 0.97
    clean = [r for r in rows if r["y"] == 0]
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    assert all(r["offending"] for r in rows if r["predicted"] and r["score"] > 0.99)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == [*docs.columns, "epoch", "position"] and got.count() > 0
    first = got.where("epoch = 0")
    assert first.count() == first.select("doc_id").distinct().count()
    assert got.join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
    assert got.where(F.col("text").rlike(r"[0-9a-f]{32}")).count() == 0


STRANGE = {
    -1: "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    -2: "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    -3: "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    -4: "xqzv wkpj vqxz jjkq zzwv qpxk vwqj kxzq", -5: "!!! ??? 999 ### a ### 555", -6: "12 843 5519 20 77 a 8123 991 " * 20,
}


def test_pipeline_drops_texts_in_no_learned_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    strange = [(k, v, None, "web", len(v)) for k, v in STRANGE.items()]
    both = docs.unionByName(spark.createDataFrame(strange, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = corpus_pipeline.stage_language_id(spark, both, DATA)
    assert kept.where("doc_id < 0").count() == 0
    assert kept.count() >= 0.998 * docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_the_language_found_decides_the_mix(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 50 == 1, "en").otherwise(F.col("lang")))
    found = corpus_pipeline.stage_language_id(spark, hidden, DATA).cache()
    both = found.select("doc_id", F.col("lang").alias("found")).join(docs, "doc_id")
    assert found.columns == docs.columns and found.where("lang is null").count() == 0
    assert both.where("found = lang").count() >= 0.98 * both.where("lang is not null").count()
    words = F.size(F.split(F.trim("text"), r"\s+"))
    mixed = lambda df: {tuple(r) for r in corpus_pipeline.stage_mixing(spark, df, DATA).select("doc_id", "epoch", "position").collect()}
    assert corpus_pipeline.stage_mixing(spark, found, DATA).columns == [*docs.columns, "epoch", "position"]
    assert mixed(found) != mixed(found.select(*[F.lit("en").alias(c) if c == "lang" else c for c in docs.columns]))
    # a source's languages have shares of their own: three times its size at most
    taken = corpus_pipeline.stage_mixing(spark, found, DATA).groupBy("source", "lang").agg(F.sum(words).alias("taken"))
    sizes = found.groupBy("source", "lang").agg(F.sum(words).alias("size"))
    assert taken.join(sizes, ["source", "lang"]).where("taken > 3 * size + 1").count() == 0
