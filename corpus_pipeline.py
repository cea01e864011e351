"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and
returns a table that is written as Parquet and read again before the next stage.  All but
the last return the columns of documents.

1. language_id: documents without a letter, and those whose text is in none of the
   learned languages by the calibrated surprise of its n-grams, go.  The others get the
   language that is found as their lang, by which the last stage mixes.
2. near_duplicates: one document of each component of the n-gram Jaccard join stays.
3. decontamination: documents that hold a benchmark item within the edit budget go.
4. secret_scan: secrets are replaced by a mask; no document goes.
5. mixing: documents in training order, a row for each time that the mix takes them, with
   epoch and position; documents that the mix does not take go.  Each language of each source
   is a source of the mix.

Models and edit distances are not expressible in SQL, so ORACLE_SQL is None and the stages
are tested against brute force and held-out figures.

Defined cases, for every stage: an empty table gives an empty table.  Columns beside those of
documents stay, whatever their names; only the last stage replaces columns named epoch and
position.  A null or empty text has no letter, so the first stage drops it; given to the
others, it has an empty set and is kept, holds no benchmark item, has no secret, and is taken
0 times by the mix, so it goes there.  Null keys, sources and languages are values like any
other; a null lang is not learned from.  Of rows with equal keys and linked texts the one with
the least text stays, of equal rows one.  Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stenoflow.llm import common as C
from stenoflow.llm import decontaminate, jaccard_join, language_id, mixing, secrets


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs)
    return docs.withColumn("lang", language_id.identified(F.col("text"), model)).where("lang is not null")


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, C.table(spark, sf_dir, "benchmark"))


def stage_secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.scan(docs, to="__secrets", fragments=True)
    masked = secrets.redact(F.col("text"), F.col("__secrets"))
    return found.withColumn("text", masked).withColumn(
        "n_chars", F.when(F.size("__secrets") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = C.free_name(docs, "__source_lang")
    return mixing.mix(docs.withColumn(both, F.to_json(F.struct("source", "lang"))), source=both).drop(both)


STAGES = [
    ("language_id", stage_language_id),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("secret_scan", stage_secret_scan),
    ("mixing", stage_mixing),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    top = f"{C.checkpoint_dir(spark)}/pipeline-{C.run_id(spark)}"
    docs, before = C.table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = f"{top}/{k}-{name}"
        with C.scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        # a stage's input goes as soon as its output is complete
        if before is not None:
            C.remove(spark, before)
        before = out
    return docs
