"""Interval timelines: gaps, crops, speaker changes, sessions and greedy segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stenoflow.operators.segmenting import Rules, segment


def gaps(speech: DataFrame, durations: DataFrame, *, video: str = "video") -> DataFrame:
    """(video, start, end): what the speech intervals leave of [0, duration]; videos without speech have none.

    Overlapping intervals are taken as their union.
    """
    w = Window.partitionBy(video).orderBy("start", "end")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    inner = speech.select(video, F.coalesce(F.max("end").over(before), F.lit(0.0)).alias("a"), F.col("start").alias("b"))
    tail = speech.groupBy(video).agg(F.max("end").alias("a")).join(durations, video).select(video, "a", F.col("duration").alias("b"))
    return inner.unionByName(tail).where("b > a").select(video, F.col("a").alias("start"), F.col("b").alias("end"))


#: Seconds of the smallest bins; those of each level are twice as wide as the ones below.
BIN = 60.0


def _bins(start: Column, end: Column, base: float) -> Column:
    """Nested bins (level, bin) that together cover an interval: at most two of each level."""
    a, b = F.floor(start / base), F.floor(end / base) + 1

    def level(k: Column) -> Column:
        width = F.pow(F.lit(2.0), k)
        lo, hi = F.ceil(a / width).cast("long"), F.floor(b / width).cast("long")
        left = F.when((lo < hi) & (F.pmod(lo, F.lit(2)) == 1), F.struct(k.alias("level"), lo.alias("bin")))
        right = F.when((lo < hi) & (F.pmod(hi, F.lit(2)) == 1), F.struct(k.alias("level"), (hi - 1).alias("bin")))
        return F.array_compact(F.array(left, right))

    top = F.floor(F.log2((b - a).cast("double"))).cast("int") + 1
    return F.when(b > a, F.flatten(F.transform(F.sequence(F.lit(0), top), level)))


def during(points: DataFrame, point: str, intervals: DataFrame, start: str, end: str, on: list[str], *, base: float = BIN) -> DataFrame:
    """Points joined with the intervals in whose bins they lie: a few too many, so the caller compares the times.

    An interval of any length is a few rows, at most two for each doubling of its length; a point is a row
    for each level of bins that any interval needs.
    """
    x = intervals.withColumn("_bin", F.explode(_bins(F.col(start), F.col(end), base)))
    levels = sorted(r[0] for r in x.select("_bin.level").distinct().collect())  # as many as doublings of the base make the longest interval
    at = F.floor(F.col(point) / base)
    probes = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(at / F.lit(1 << k)).alias("bin")) for k in levels])
    none = F.array().cast("array<struct<level:int,bin:bigint>>")
    p = points.withColumn("_bin", F.explode(probes if levels else none))
    # either side has many more rows than its table, so neither is broadcast by the table's size
    return p.join(x.hint("merge"), [*on, "_bin"]).drop("_bin")


def crop(timeline: DataFrame, windows: DataFrame, *, video: str = "video", bucket: float = BIN) -> DataFrame:
    """Intersections of timeline intervals (start, end) with windows (w, w_start, w_end) of the same video.

    Two intervals meet where one begins during the other, so the join is on nested bins of time, and an interval
    of any length is copied a few times only.
    """
    s, x = timeline.select(video, "start", "end"), windows.select(video, "w", "w_start", "w_end")
    first = during(s, "start", x, "w_start", "w_end", [video], base=bucket).where(F.col("w_start") <= F.col("start"))
    then = during(x, "w_start", s, "start", "end", [video], base=bucket).where(F.col("w_start") > F.col("start"))
    met = first.select(*x.columns, "start", "end").unionByName(then.select(*x.columns, "start", "end"))
    return met.where((F.col("start") < F.col("w_end")) & (F.col("end") > F.col("w_start"))).select(
        video, "w", F.greatest("start", "w_start").alias("start"), F.least("end", "w_end").alias("end"))


def crop_grid(timeline: DataFrame, every: float, length: float, count: int, *, video: str = "video") -> DataFrame:
    """Intersections of timeline intervals with the windows [w * every, w * every + length), w from 0 to count - 1, of all videos.

    The windows that an interval meets follow from its times, so each row finds its own, and windows without speech are never made.
    """
    low = F.greatest(F.floor((F.col("start") - length) / every), F.lit(0))
    high = F.least(F.floor(F.col("end") / every), F.lit(count - 1))
    numbers = F.when(low <= high, F.sequence(low.cast("int"), high.cast("int")))
    met = timeline.select(video, "start", "end", F.explode(numbers).alias("w"))
    first, last = F.col("w") * every, F.col("w") * every + length
    return met.where((F.col("start") < last) & (F.col("end") > first)).select(
        video, "w", F.greatest("start", first).alias("start"), F.least("end", last).alias("end"))


def label_changes(df: DataFrame, group: str, order: str, label: str) -> DataFrame:
    """Rows at which the label differs from that of the row before."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("previous", F.lag(label).over(w)).where(F.col("previous") != F.col(label))


def overlaps(df: DataFrame, group: str, label: str, *, bucket: float = BIN) -> DataFrame:
    """(group, start, end, label, until): intervals that begin while one of another label goes on, and its latest end."""
    later = df.select(group, "start", "end", label)
    going = df.select(group, F.col("start").alias("_from"), F.col("end").alias("_to"), F.col(label).alias("_label"))
    met = during(later, "start", going, "_from", "_to", [group], base=bucket).where(
        (F.col("_from") <= F.col("start")) & (F.col("_to") > F.col("start")) & (F.col("_label") != F.col(label)))
    return met.groupBy(group, "start", "end", label).agg(F.max("_to").alias("until"))


def sessions(df: DataFrame, group: str, ts: Column, gap_seconds: int) -> DataFrame:
    """(group, session_start, session_end, n): runs of events less than the gap apart."""
    return (
        df.groupBy(group, F.session_window(ts, f"{gap_seconds} seconds").alias("w"))
        .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("n"))
        .drop("w")
    )


def greedy_segments(
    silences: DataFrame, extents: DataFrame, *, video: str = "video", least: float = 10.0, most: float = 20.0
) -> DataFrame:
    """(video, seg_idx, start, end): cuts in the middle of the longest silence of each window.

    From the cursor, the window is [cursor + least, cursor + most]; without silence in it the cut
    is at its end.  A silence of more than `least` seconds that starts at the cursor is skipped.
    Extents have (video, duration); the last segment is clipped to it.
    """
    quiet, ends = silences.withColumnRenamed(video, "video"), extents.withColumnRenamed(video, "video")
    return segment(quiet, ends, rules=Rules(least, most, inside=False)).withColumnRenamed("video", video)
