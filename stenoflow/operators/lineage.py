"""Cutting a plan's lineage where a result must not be computed twice in different ways."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def place(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineage; only a session on this machine alone gets a folder of its own."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("a cluster needs a shared folder in spark.checkpoint.dir")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df, written once as a table in the shared checkpoint folder."""
    spark = df.sparkSession
    path = f"{place(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
