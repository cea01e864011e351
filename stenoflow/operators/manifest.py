"""Manifest assembly: keys, candidates, long form, joins and cascades of link tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stenoflow.functions.links import blank_to_null
from stenoflow.operators.lineage import cut

#: Rows of a key and side that meet in one cell of `all_pairs`, about; pairs and tasks of its last step.
CELL, TASK_PAIRS, MOST_TASKS = 4_096, 4_000_000, 20_000
#: Link columns with their modality and folder.
LINK_TYPES = {
    "mp4_video_link": ("audio", "downloaded_audio/mp4_converted"),
    "youtube_link": ("audio", "downloaded_audio/youtube_converted"),
    "m3u8_link": ("audio", "downloaded_audio/m3u8_streams"),
    "generic_video_link": ("audio", "downloaded_audio/generic_video"),
    "generic_m3u8_link": ("audio", "downloaded_audio/generic_m3u8"),
    "processed_video_link": ("audio", "downloaded_audio/processed_video"),
    "mp3_link": ("audio", "downloaded_audio/mp3_audio"),
    "pdf_link": ("transcript", "downloaded_transcript/pdf_transcripts"),
    "html_link": ("transcript", "downloaded_transcript/html_transcripts"),
    "dynamic_html_link": ("transcript", "downloaded_transcript/dynamic_html_transcripts"),
    "processed_transcript_html_link": ("transcript", "downloaded_transcript/processed_html_transcripts"),
    "processed_transcript_text_link": ("transcript", "downloaded_transcript/processed_text_transcripts"),
    "doc_link": ("transcript", "downloaded_transcript/doc_transcripts"),
    "txt_link": ("transcript", "downloaded_transcript/txt_transcripts"),
    "srt_link": ("subtitle", "downloaded_subtitle/srt_subtitles"),
}


def candidates(manifest: DataFrame, *, video: str = "video_id", transcript: str = "transcript_id") -> DataFrame:
    """(video_id, ord, candidate): transcript ids under which a video's transcript may be stored."""
    v, t = blank_to_null(F.col(video)), blank_to_null(F.col(transcript))
    id_ = F.coalesce(v, t, F.raise_error(F.lit("a manifest row has neither id")))
    options = F.when(t.isNotNull(), F.array(t, F.concat_ws("_", id_, t))).otherwise(F.array(id_))
    return manifest.select(id_.alias("video_id"), F.posexplode(options).alias("ord", "candidate"))


def session_id(video: Column, transcript: Column, ordinal: Column) -> Column:
    """video_transcript where both are known and differ, else the known one, else the row's number."""
    v, t = blank_to_null(video), blank_to_null(transcript)
    return F.when(v.isNotNull() & t.isNotNull() & (v != t), F.concat_ws("_", v, t)).otherwise(
        F.coalesce(v, t, ordinal.cast("string"))
    )


def long_form(manifest: DataFrame, ids: list[str]) -> DataFrame:
    """One row per non-empty link: ids, link_type, url, modality, subfolder."""
    present = [c for c in manifest.columns if c in LINK_TYPES]
    kind = F.create_map(*[F.lit(v) for c in present for v in (c, LINK_TYPES[c][0])])
    folder = F.create_map(*[F.lit(v) for c in present for v in (c, LINK_TYPES[c][1])])
    return (
        manifest.unpivot(ids, present, "link_type", "url")
        .withColumn("url", blank_to_null(F.col("url"))).where("url is not null")
        .withColumn("modality", kind[F.col("link_type")]).withColumn("subfolder", folder[F.col("link_type")])
    )


def all_pairs(left: DataFrame, right: DataFrame, on: str, left_id: str, right_id: str) -> DataFrame:
    """Inner join n x m per key, dealt out by what it gives instead of by what it reads.

    The sides are small beside their pairs, so tasks that are cut by size of input are too few.  Rows of a key are dealt
    to blocks by a hash of their id; a pair of blocks is a cell with rows of its own, and cells are spread over
    as many tasks as the number of pairs asks for.  A row is copied once for each block of the other side, which adds
    a few thousandths of the pairs; no task holds more of a key than the blocks of its cells.
    """
    count = lambda df, n: df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias(n))
    counts = cut(count(left, "_n").join(count(right, "_m"), on))
    pairs = counts.agg(F.sum(F.col("_n").cast("double") * F.col("_m"))).first()[0] or 0
    tasks = min(max(int(pairs / TASK_PAIRS), left.sparkSession.sparkContext.defaultParallelism), MOST_TASKS)
    blocks = counts.select(on, F.ceil(F.col("_n") / CELL).cast("int").alias("_a"), F.ceil(F.col("_m") / CELL).cast("int").alias("_b"))

    def dealt(df: DataFrame, id_: str, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(id_), F.col(own)).cast("int").alias(f"{own}_at")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_at")
        return df.join(blocks, on).select(*df.columns, mine, every).repartition(tasks, on, "_a_at", "_b_at")

    x, y = dealt(left, left_id, "_a", "_b"), dealt(right, right_id, "_b", "_a")
    return x.hint("merge").join(y, [on, "_a_at", "_b_at"]).drop("_a_at", "_b_at")


def merge_on_key(
    transcripts: DataFrame, videos: DataFrame, key_t: Callable[[Column], Column], key_v: Callable[[Column], Column]
) -> DataFrame:
    """Inner join of (transcript_id, …) and (video_id, …) on keys derived from their ids, n x m per key."""
    t = transcripts.withColumn("join_key", key_t(F.col("transcript_id")))
    v = videos.withColumn("join_key", key_v(F.col("video_id")))
    return all_pairs(t, v, "join_key", "transcript_id", "video_id").withColumn("merged_id", F.concat_ws("_", "transcript_id", "video_id"))


def merge_counts(
    transcripts: DataFrame, videos: DataFrame, key_t: Callable[[Column], Column], key_v: Callable[[Column], Column]
) -> DataFrame:
    """What merge_on_key adds up to by key, from a row for each key and side: (join_key, pairs, transcripts, videos, first_id, last_id).

    Transcripts and videos are distinct ids.  First and last merged ids are those of the ids, as long as no id under a
    key begins with another one whole, as ids that end with the key do not.
    """

    def side(df: DataFrame, id_: str, key: Callable[[Column], Column], name: str) -> DataFrame:
        return df.groupBy(key(F.col(id_)).alias("join_key")).agg(
            F.count(id_).alias(f"n_{name}"), F.count_distinct(id_).alias(name), F.min(id_).alias(f"first_{name}"), F.max(id_).alias(f"last_{name}"))

    both = side(transcripts, "transcript_id", key_t, "transcripts").join(side(videos, "video_id", key_v, "videos"), "join_key")
    end = lambda which: F.concat_ws("_", f"{which}_transcripts", f"{which}_videos").alias(f"{which}_id")
    return both.select("join_key", (F.col("n_transcripts") * F.col("n_videos")).alias("pairs"), "transcripts", "videos", end("first"), end("last"))


def unmatched(transcripts: DataFrame, videos: DataFrame, key: str) -> DataFrame:
    """(key, side) of the distinct keys that only one side has."""
    t = transcripts.select(key).distinct().withColumn("_t", F.lit(True))
    v = videos.select(key).distinct().withColumn("_v", F.lit(True))
    both = t.join(v, key, "full_outer").where("_t is null or _v is null")
    return both.select(key, F.when(F.col("_v").isNull(), "transcript").otherwise("video").alias("side"))


def cascade(
    transcripts: DataFrame, videos: DataFrame, explicit: DataFrame, *, date: str = "date", cutoff: str
) -> DataFrame:
    """(transcript_id, video_id, match_type): each transcript by the first rule that applies.

    Rules: an explicit link to a known video; a date with one video; a date with several; and from the
    cutoff date on, for those still without a match, the videos of the day after.  What a rule leaves to the next ones is
    written once, as each reads it several times.
    """
    t, v = transcripts.select("transcript_id", date), videos.select("video_id", date)
    first = cut(
        explicit.join(v.select("video_id"), "video_id", "left_semi").dropDuplicates(["transcript_id", "video_id"])
        .join(t.select("transcript_id"), "transcript_id", "left_semi")
        .select("transcript_id", "video_id", F.lit("explicit").alias("match_type"))
    )
    rest = cut(t.join(first.select("transcript_id").distinct(), "transcript_id", "left_anti"))
    per_date = v.groupBy(date).agg(F.count("*").alias("n"))
    counted = v.join(per_date, date)
    by_date = all_pairs(rest, counted, date, "transcript_id", "video_id").select(
        "transcript_id", "video_id", F.when(F.col("n") == 1, "unique_date").otherwise("multi_date").alias("match_type")
    )
    left = cut(rest.join(v.select(date).distinct(), date, "left_anti").where(F.col(date) >= F.lit(cutoff).cast("date")))
    late = all_pairs(left, v.select("video_id", F.date_sub(date, 1).alias(date)), date, "transcript_id", "video_id").select(
        "transcript_id", "video_id", F.lit("next_day").alias("match_type")
    )
    return first.unionByName(by_date).unionByName(late)


def cascade_counts(
    transcripts: DataFrame, videos: DataFrame, explicit: DataFrame, *, date: str = "date", cutoff: str
) -> DataFrame:
    """What `cascade` adds up to by transcript (ids are unique): (transcript_id, match_type, videos, first_video), without making the pairs."""
    t, v = transcripts.select("transcript_id", date), videos.select("video_id", date)
    linked = explicit.join(v.select("video_id"), "video_id", "left_semi").dropDuplicates(["transcript_id", "video_id"])
    first = linked.join(t.select("transcript_id"), "transcript_id", "left_semi").groupBy("transcript_id").agg(
        F.count("*").alias("videos"), F.min("video_id").alias("first_video"))
    rest = t.join(first.select("transcript_id"), "transcript_id", "left_anti")
    days = v.where(F.col(date).isNotNull()).groupBy(date).agg(F.count("*").alias("videos"), F.min("video_id").alias("first_video"))
    by_date = rest.join(days, date).withColumn("match_type", F.when(F.col("videos") == 1, "unique_date").otherwise("multi_date"))
    left = rest.join(days.select(date), date, "left_anti").where(F.col(date) >= F.lit(cutoff).cast("date"))
    late = left.join(days.withColumn(date, F.date_sub(date, 1)), date).withColumn("match_type", F.lit("next_day"))
    out = ["transcript_id", "match_type", "videos", "first_video"]
    return first.withColumn("match_type", F.lit("explicit")).select(*out).unionByName(by_date.select(*out)).unionByName(late.select(*out))


def last_wins(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """The value of the row of highest order for each key."""
    return df.groupBy(*key).agg(F.max_by(value, order).alias(value))


def first_wins(df: DataFrame, key: list[str], *order: str) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def anti(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows of df whose key is not in known; null keys stay."""
    return df.join(known.select(*on).distinct(), on, "left_anti")


def strict_one_to_one(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of the rows whose key is unique on their own side."""
    alone = lambda d: d.join(d.groupBy(*on).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n"), on)
    return alone(left).join(alone(right), on)


def shards(df: DataFrame, order: list[str], tasks: int) -> DataFrame:
    """Even contiguous shards by order, the last one with the remainder.

    Ranks come from a range sort and per-partition counts, so no task sees all rows.
    """
    ranked = rank_rows(df, order)
    n = df.count()
    size = n // tasks
    shard = F.lit(tasks - 1) if size == 0 else F.least(F.floor((F.col("rank") - 1) / size), F.lit(tasks - 1))
    return ranked.withColumn("shard", shard.cast("int"))


def rank_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """df with `rank` 1, 2, … in the given order, by range partitions and their offsets."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    parts = parts.withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33))
    parts = cut(parts)
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return parts.join(F.broadcast(offsets), "_p").withColumn("rank", F.col("_o") + F.col("_i") + 1).drop("_p", "_i", "_o")


def unique_or_raise(df: DataFrame, key: list[str]) -> DataFrame:
    """df; a repeated key ends the query.  Counted by key, so a hot key does not meet in one task as rows."""
    n = df.groupBy(*key).agg(F.count("*").alias("_n"))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key])
    bad = n.agg(F.max(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated key: "), shown))).otherwise(F.lit(0))).alias("_bad"))
    return df.join(F.broadcast(bad), F.coalesce("_bad", F.lit(0)).cast("int") == 0).drop("_bad")


def lookup_inner(df: DataFrame, other: DataFrame, on: str, order: str, value: str) -> DataFrame:
    """Rows of df with the value of the last row of other under the same key; rows without one go."""
    return df.join(last_wins(other, [on], order, value), on)


def both_unmatched(left: DataFrame, right: DataFrame, key: str, examples: int) -> DataFrame:
    """(side, key, n): of the keys that only one side has, the first examples of each side, and how many there are."""
    only = unmatched(left, right, key)
    w = Window.partitionBy("side").orderBy(key)
    n = only.groupBy("side").agg(F.count("*").alias("n"))
    first = only.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= examples).drop("_r")
    return first.join(F.broadcast(n), "side")


def id_first(df: DataFrame, *ids: str) -> DataFrame:
    """Ids first, the other columns in their order."""
    return df.select(*ids, *[c for c in df.columns if c not in ids])


def page_of(df: DataFrame, offset: int, n: int, *order: Column) -> DataFrame:
    """n rows after the first `offset` in the given order."""
    return df.orderBy(*order).offset(offset).limit(n)
