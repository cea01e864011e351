"""Sinks: tables, documents per key, batches and partitioned output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append(df: DataFrame, path: str) -> None:
    """Appends rows; every file has the header, so none is doubled when the folder is read."""
    table_csv(df, path, "append")


def alignment_documents(segments: DataFrame, keys: list[str], order: str = "seg_idx") -> DataFrame:
    """One row per key with its segments as a JSON document."""
    rest = [c for c in segments.columns if c not in keys]
    listed = F.sort_array(F.collect_list(F.struct(order, *[c for c in rest if c != order])))
    return segments.groupBy(*keys).agg(listed.alias("segments")).select(*keys, F.to_json(F.struct("segments")).alias("document"))


def by_partition(df: DataFrame, path: str, columns: list[str], rows_per_file: int = 1_000_000) -> None:
    """Parquet by partition columns; writing again replaces only the partitions that occur in df."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).partitionBy(*columns).parquet(path)


def batch_documents(df: DataFrame, size: int, *, id_: str = "transcript_id", ordinal: str = "ord") -> DataFrame:
    """A JSON document for every range of `size` ordinals: metadata, and contents keyed by id.

    Needs columns id_, ordinal, content, raw, url; raw bytes are written as base64.
    """
    content = F.struct(
        F.when(F.col("raw").isNotNull(), "bytes").otherwise("text").alias("type"), F.coalesce(F.base64("raw"), "content").alias("data"),
        F.when(F.col("raw").isNotNull(), "base64").alias("encoding"))
    entry = F.struct(content.alias("content"), F.col("url"))
    start = F.floor(F.col(ordinal) / size) * size
    grouped = df.groupBy(start.alias("start_idx")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(id_).alias("k"), entry.alias("v"))))).alias("transcripts"), F.count("*").alias("n"))
    meta = F.struct(F.col("start_idx").cast("int"), (F.col("start_idx") + size - 1).cast("int").alias("end_idx"), F.col("n").cast("int").alias("transcript_count"))
    return grouped.select("start_idx", F.to_json(F.struct(meta.alias("metadata"), "transcripts")).alias("document"))


def report(df: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def staged(fresh: DataFrame, path: str, key: str) -> DataFrame:
    """Rows of fresh whose key the stage table lacks, appended to it; the first time, all of them."""
    spark = fresh.sparkSession
    try:
        known = spark.read.parquet(path).select(key).distinct()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = None
    todo = fresh if known is None else fresh.join(known, key, "left_anti")
    todo.write.mode("append").parquet(path)
    return spark.read.parquet(path)
