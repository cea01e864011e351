"""Two-level selection of the best transcript per recording, and quality figures.

Aligned segments have video, transcript, format, seg_idx, cer and duration; a null cer is
an alignment that failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRATEGIES = ("best_only", "threshold_all", "force_all")


def median_cer(aligned: DataFrame) -> DataFrame:
    """(video, transcript, format, cer, segments): exact median, 1.0 where no segment has one."""
    return aligned.groupBy("video", "transcript", "format").agg(
        F.coalesce(F.median("cer"), F.lit(1.0)).alias("cer"), F.count("cer").alias("segments")
    )


def _first(df: DataFrame, group: list[str], *order: Column | str) -> DataFrame:
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where("_r = 1").drop("_r")


def best_format(aligned: DataFrame) -> DataFrame:
    """Level 1: the format with the lowest median below 1.0 of each transcript."""
    return _first(median_cer(aligned).where("cer < 1.0"), ["video", "transcript"], "cer", "format")


def select_transcripts(level1: DataFrame, strategy: str, threshold: float) -> DataFrame:
    """Level 2: the best transcript within the threshold, all within it, or all."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "force_all":
        return level1
    within = level1.where(F.col("cer") <= threshold)
    return within if strategy == "threshold_all" else _first(within, ["video"], "cer", "transcript")


def alignment_stats(segments: DataFrame) -> DataFrame:
    """Per video: median (0.0 if none), total and well-aligned duration, skipped segments, transcripts."""
    usable = F.col("cer").isNotNull() & F.col("duration").isNotNull()
    return segments.groupBy("video").agg(
        F.round(F.coalesce(F.median(F.when(usable, F.col("cer"))), F.lit(0.0)), 4).alias("median_cer"),
        F.round(F.sum(F.when(usable, F.col("duration")).otherwise(0.0)), 4).alias("total"),
        F.round(F.sum(F.when(usable & (F.col("cer") <= 0.3), F.col("duration")).otherwise(0.0)), 4).alias("upto_30"),
        F.round(F.sum(F.when(usable & (F.col("cer") <= 0.1), F.col("duration")).otherwise(0.0)), 4).alias("upto_10"),
        F.count_if(~usable).alias("skipped"),
        F.count_distinct("transcript").alias("transcripts"),
    )


def below_thresholds(segments: DataFrame, thresholds: list[float]) -> DataFrame:
    """Duration and share of it at or below each threshold, in one pass."""
    sums = segments.agg(
        F.sum("duration").alias("all"),
        *[F.sum(F.when(F.col("cer") <= t, F.col("duration")).otherwise(0.0)).alias(f"t{i}") for i, t in enumerate(thresholds)],
    )
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("duration")) for i, t in enumerate(thresholds)])
    return sums.select(F.explode(rows).alias("r"), "all").select(
        "r.threshold", F.round("r.duration", 4).alias("duration"),
        F.round(100 * F.try_divide(F.col("r.duration"), F.col("all")), 4).alias("percent"),
    )
