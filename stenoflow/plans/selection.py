"""Selection and quality figures over aligned segments (lineitem as the segment table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stenoflow.operators import quantiles as Q
from stenoflow.operators import selection as S
from stenoflow.plans.registry import query


def segments(table) -> DataFrame:
    """Aligned segments: order = video, supplier = transcript, return flag = format."""
    return table("lineitem").select(
        F.col("l_orderkey").alias("video"), F.col("l_suppkey").alias("transcript"),
        F.col("l_returnflag").alias("format"), F.col("l_linenumber").alias("seg_idx"),
        (F.col("l_discount") * 10).alias("cer"), F.col("l_quantity").alias("duration"),
    )


SEG = """SELECT l_orderkey AS video, l_suppkey AS transcript, l_returnflag AS format, l_linenumber AS seg_idx,
 l_discount * 10 AS cer, l_quantity AS duration FROM lineitem"""
LEVEL1 = f"""seg AS ({SEG}),
med AS (SELECT video, transcript, format, coalesce(median(cer), 1.0) AS cer, count(cer) AS segments
        FROM seg GROUP BY ALL),
l1 AS (SELECT * FROM med WHERE cer < 1.0
       QUALIFY row_number() OVER (PARTITION BY video, transcript ORDER BY cer, format) = 1)"""


@query("modality_select", f"WITH {LEVEL1} SELECT video, transcript, format, round(cer, 4) AS cer, segments FROM l1")
def modality_select(table):
    """Best format of every transcript."""
    return S.best_format(segments(table)).withColumn("cer", F.round("cer", 4))


@query(
    "transcript_select",
    f"""WITH {LEVEL1},
b AS (SELECT 'best_only' AS strategy, * FROM (SELECT * FROM l1 WHERE cer <= 0.3
      QUALIFY row_number() OVER (PARTITION BY video ORDER BY cer, transcript) = 1)),
t AS (SELECT 'threshold_all' AS strategy, * FROM l1 WHERE cer <= 0.3),
f AS (SELECT 'force_all' AS strategy, * FROM l1)
SELECT strategy, video, transcript, format, round(cer, 4) AS cer FROM
(SELECT * FROM b UNION ALL SELECT * FROM t UNION ALL SELECT * FROM f)""",
)
def transcript_select(table):
    """Selected transcripts under each strategy."""
    level1 = S.best_format(segments(table))
    parts = [S.select_transcripts(level1, s, 0.3).withColumn("strategy", F.lit(s)) for s in S.STRATEGIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        "strategy", "video", "transcript", "format", F.round("cer", 4).alias("cer")
    )


@query(
    "alignment_summary",
    f"""WITH {LEVEL1},
t AS (SELECT * FROM l1 WHERE cer <= 0.3)
SELECT video, count(*) AS selected,
 string_agg(transcript || '/' || format || '/' || segments, ';' ORDER BY transcript) AS transcripts FROM t GROUP BY video""",
)
def alignment_summary(table):
    """One document per video with its selected transcripts, in order."""
    chosen = S.select_transcripts(S.best_format(segments(table)), "threshold_all", 0.3)
    return chosen.groupBy("video").agg(
        F.count("*").alias("selected"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("transcript", "format", "segments"))),
                lambda s: F.concat_ws("/", s["transcript"].cast("string"), s["format"], s["segments"].cast("string")),
            ),
            ";",
        ).alias("transcripts"),
    )


@query(
    "alignment_stats",
    f"""WITH seg AS ({SEG})
SELECT video, round(coalesce(median(cer) FILTER (cer IS NOT NULL AND duration IS NOT NULL), 0.0), 4) AS median_cer,
 round(sum(duration), 4) AS total, round(sum(CASE WHEN cer <= 0.3 THEN duration ELSE 0 END), 4) AS upto_30,
 round(sum(CASE WHEN cer <= 0.1 THEN duration ELSE 0 END), 4) AS upto_10,
 count(*) FILTER (cer IS NULL OR duration IS NULL) AS skipped, count(DISTINCT transcript) AS transcripts
FROM seg GROUP BY video""",
)
def alignment_stats(table):
    return S.alignment_stats(segments(table))


THRESHOLDS = [0.1, 0.2, 0.3, 0.5, 0.7]


@query(
    "cer_thresholds",
    f"""WITH seg AS ({SEG}), t AS (SELECT unnest([0.1, 0.2, 0.3, 0.5, 0.7]::DOUBLE[]) AS threshold)
SELECT threshold, round(sum(CASE WHEN cer <= threshold THEN duration ELSE 0 END), 4) AS duration,
 round(100 * sum(CASE WHEN cer <= threshold THEN duration ELSE 0 END) / sum(duration), 4) AS percent
FROM seg, t GROUP BY threshold""",
)
def cer_thresholds(table):
    return S.below_thresholds(segments(table), THRESHOLDS)


@query(
    "cer_histogram",
    f"WITH seg AS ({SEG}) SELECT round_even(cer, 2) AS cer, count(*) AS n FROM seg GROUP BY 1",
)
def cer_histogram(table):
    return segments(table).groupBy(F.bround("cer", 2).alias("cer")).agg(F.count("*").alias("n")).orderBy("cer")


@query(
    "cer_report",
    f"""WITH seg AS ({SEG})
SELECT count(*) AS segments, round(avg(cer), 6) AS mean_cer, round(median(cer), 6) AS median_cer,
 round(sum(duration) / 3600, 4) AS hours, count(DISTINCT video) AS videos FROM seg""",
)
def cer_report(table):
    """The whole table is one group: its median is selected, not gathered."""
    seg = segments(table)
    median = Q.quantiles(seg, "cer", [0.5]).select(F.round("quantile", 6).alias("median_cer"))
    return seg.agg(
        F.count("*").alias("segments"), F.round(F.avg("cer"), 6).alias("mean_cer"), F.round(F.sum("duration") / 3600, 4).alias("hours"),
        F.count_distinct("video").alias("videos"),
    ).join(median, F.lit(True), "left").select("segments", "mean_cer", "median_cer", "hours", "videos")


@query(
    "cer_quantiles",
    f"""WITH seg AS ({SEG}), s AS (SELECT unnest([0.0, 0.1, 0.15, 0.5, 0.9, 0.99, 1.0]::DOUBLE[]) AS share)
SELECT format, share, round(CASE share WHEN 0.0 THEN quantile_cont(duration, 0.0) WHEN 0.1 THEN quantile_cont(duration, 0.1) WHEN 0.15 THEN quantile_cont(duration, 0.15)
 WHEN 0.5 THEN quantile_cont(duration, 0.5) WHEN 0.9 THEN quantile_cont(duration, 0.9) WHEN 0.99 THEN quantile_cont(duration, 0.99) ELSE max(duration) END, 6) AS duration,
 round(CASE share WHEN 0.0 THEN quantile_cont(cer, 0.0) WHEN 0.1 THEN quantile_cont(cer, 0.1) WHEN 0.15 THEN quantile_cont(cer, 0.15)
 WHEN 0.5 THEN quantile_cont(cer, 0.5) WHEN 0.9 THEN quantile_cont(cer, 0.9) WHEN 0.99 THEN quantile_cont(cer, 0.99) ELSE max(cer) END, 6) AS cer
FROM seg, s GROUP BY format, share""",
)
def cer_quantiles(table):
    """Quantiles of duration and error rate by format."""
    shares, seg = [0.0, 0.1, 0.15, 0.5, 0.9, 0.99, 1.0], segments(table)
    one, two = (Q.quantiles(seg, c, shares, ["format"]).withColumnRenamed("quantile", c) for c in ("duration", "cer"))
    return one.join(two, ["format", "share"]).select("format", "share", F.round("duration", 6).alias("duration"), F.round("cer", 6).alias("cer"))


COVER = f"""seg AS ({SEG}),
aud AS (SELECT o_orderkey AS video, floor(o_totalprice / 100) AS audio FROM orders),
cov AS (SELECT a.video, a.audio, s.d, s.d / a.audio AS ratio FROM aud a
        LEFT JOIN (SELECT video, sum(duration) AS d FROM seg GROUP BY video) s USING (video))"""


def _coverage(table) -> DataFrame:
    audio = table("orders").select(
        F.col("o_orderkey").alias("video"), F.floor(F.col("o_totalprice") / 100).cast("double").alias("audio")
    )
    covered = segments(table).groupBy("video").agg(F.sum("duration").alias("d"))
    return audio.join(covered, "video", "left").withColumn(
        "ratio", F.when(F.col("audio") > 0, F.try_divide(F.col("d"), F.col("audio")))
    )


@query(
    "coverage_ratio",
    f"""WITH {COVER}
SELECT count(*) AS audios, count(*) FILTER (d IS NULL) AS unaligned,
 round(coalesce(sum(audio) FILTER (d IS NULL), 0.0), 4) AS unaligned_seconds,
 round(avg(CASE WHEN audio > 0 THEN ratio END), 6) AS mean_ratio FROM cov""",
)
def coverage_ratio(table):
    return _coverage(table).agg(
        F.count("*").alias("audios"), F.count_if(F.col("d").isNull()).alias("unaligned"),
        F.round(F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("audio"))), F.lit(0.0)), 4).alias("unaligned_seconds"),
        F.round(F.avg("ratio"), 6).alias("mean_ratio"),
    )


@query(
    "coverage_histogram",
    f"""WITH {COVER}, r AS (SELECT ratio FROM cov WHERE audio > 0 AND ratio IS NOT NULL),
e AS (SELECT min(ratio) AS lo, max(ratio) AS hi FROM r)
SELECT CAST(least(floor((ratio - lo) / (hi - lo) * 20) + 1, 20) AS BIGINT) AS bin, count(*) AS n FROM r, e GROUP BY 1""",
)
def coverage_histogram(table):
    """Twenty equal bins between the least and the largest ratio; the top edge is in the last bin."""
    ratios = _coverage(table).where("ratio is not null").select("ratio")
    edges = ratios.agg(F.min("ratio").alias("lo"), F.max("ratio").alias("hi"))
    place = F.floor((F.col("ratio") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 20) + 1
    return (
        ratios.join(F.broadcast(edges)).select(F.least(place, F.lit(20)).cast("long").alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("n"))
    )


@query(
    "cer_filter",
    f"""WITH seg AS ({SEG}) SELECT video, transcript, seg_idx, round(cer, 4) AS cer, duration
FROM seg WHERE cer < 0.1 AND duration BETWEEN 3 AND 20""",
)
def cer_filter(table):
    """Training rows: a strict error bound and the segment length policy."""
    return segments(table).where((F.col("cer") < 0.1) & F.col("duration").between(3, 20)).select(
        "video", "transcript", "seg_idx", F.round("cer", 4).alias("cer"), "duration"
    )


@query(
    "subset_budget",
    f"""WITH seg AS ({SEG}), r AS (
SELECT format, video, seg_idx, transcript, duration, sum(duration) OVER (PARTITION BY format
  ORDER BY md5(video || '/' || seg_idx), video, seg_idx, transcript ROWS UNBOUNDED PRECEDING) AS running,
  sum(duration) OVER (PARTITION BY format) AS total FROM seg)
SELECT format, count(*) AS segments, round(sum(duration), 4) AS duration FROM r WHERE running <= 0.03 * total GROUP BY format""",
)
def subset_budget(table):
    """Three per cent of each format's duration, in hash order: buckets first, then within them."""
    s = segments(table).withColumn("h", F.md5(F.concat_ws("/", F.col("video").cast("string"), F.col("seg_idx").cast("string"))))
    s = s.withColumn("bucket", F.substring("h", 1, 2))
    per = s.groupBy("format", "bucket").agg(F.sum("duration").alias("inside"))
    before = Window.partitionBy("format").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "format", "bucket", F.coalesce(F.sum("inside").over(before), F.lit(0.0)).alias("before"),
        F.sum("inside").over(Window.partitionBy("format")).alias("total"),
    )
    inside = Window.partitionBy("format", "bucket").orderBy("h", "video", "seg_idx", "transcript").rowsBetween(Window.unboundedPreceding, 0)
    running = F.col("before") + F.sum("duration").over(inside)
    kept = s.join(per, ["format", "bucket"]).withColumn("running", running).where(F.col("running") <= 0.03 * F.col("total"))
    return kept.groupBy("format").agg(F.count("*").alias("segments"), F.round(F.sum("duration"), 4).alias("duration"))
