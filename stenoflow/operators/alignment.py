"""Text-to-text alignment by character error rate, set-based.

Segments (seg, asr) are located in transcripts (doc, toks: array of tokens).  Shared token
n-grams give anchors; around them windows of the segment's length are compared (coarse),
and start and length of the best windows are refined (fine).  Distances are Spark's
levenshtein for single windows, and one sweep of bit vectors for all windows of a region;
candidates are ranked by (cer, start, length), so ties are settled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stenoflow.functions import text as X
from stenoflow.operators.lineage import cut
from stenoflow.operators.sweep import Pattern

REGION_CER = 0.3
GLOBAL_CER = 0.45
MARGIN = 15
TOP = 3
NGRAM = 4
#: The segments' n-grams are broadcast up to this many bytes; a row counts ROW_BYTES beside its text.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64
#: Up to so many n-grams of segments are looked up in a set that each worker holds.
NEAR_GRAMS = 100_000


def cer(asr: Column, human: Column) -> Column:
    """Edit distance over the length of the recognised text; 1.0 where that is empty."""
    return F.when(F.char_length(asr) == 0, 1.0).otherwise(F.levenshtein(asr, human) / F.char_length(asr))


def _ngrams(tokens: Column, n: int) -> Column:
    last = F.size(tokens) - n
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(tokens, i + 1, n), " "))
    ).otherwise(F.array().cast("array<string>"))


def _keys(tokens: Column, n: int) -> Column:
    """A hash of each n-gram: equal n-grams have equal ones, and they take half the time of the texts."""
    last = F.size(tokens) - n
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(n)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _shares(grams: set[tuple], n: int) -> Callable[[pa.Array], pa.Array]:
    """Whether a text, or an array of tokens, has one of the n-grams."""

    def find(values: pa.Array) -> pa.Array:
        out = []
        for value in values:
            v = value.as_py()
            tokens = v.split() if isinstance(v, str) else v or []
            out.append(not grams.isdisjoint(zip(*[tokens[k:] for k in range(n)], strict=False)))
        return pa.array(out, pa.bool_())

    return find


def nearby(segments: DataFrame, transcripts: DataFrame, n: int = NGRAM) -> DataFrame:
    """The transcripts (doc, toks) that share an n-gram with a segment, written once.

    Where transcripts have a column text too, toks are its words; then texts are cut into words in Python, which takes
    half the time, and only those that are kept in Spark.  Above NEAR_GRAMS n-grams of segments their hashes are joined:
    one that two n-grams share keeps a transcript too many, which has no anchor later; none is lost.
    """
    whole = "text" in transcripts.columns
    read = transcripts.select("doc", "text" if whole else "toks")
    last = F.size("stoks") - n
    grams = segments.where(last >= 0).select(F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("stoks", i + 1, n))).alias("gram"))
    some = grams.distinct().limit(NEAR_GRAMS + 1).collect()
    if len(some) <= NEAR_GRAMS:
        hit = read.where(F.arrow_udf(_shares({tuple(r[0]) for r in some}, n), "boolean")(F.col(read.columns[1])))
    else:
        keys = segments.select(F.explode(_keys(F.col("stoks"), n)).alias("key")).distinct()
        keys = F.broadcast(keys) if keys.count() * ROW_BYTES <= BROADCAST_BYTES else keys
        hit = transcripts.select("doc", F.explode(_keys(F.col("toks"), n)).alias("key")).join(keys, "key", "left_semi")
    kept = read.join(cut(hit.select("doc").distinct()), "doc", "left_semi")
    return cut(kept.select("doc", (X.words(F.col("text")) if whole else F.col("toks")).alias("toks")))


def parts(df: DataFrame) -> int:
    """Tasks for rows that cost far more than they weigh."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)


def anchors(segments: DataFrame, transcripts: DataFrame, n: int = NGRAM, grams: DataFrame | None = None) -> DataFrame:
    """(seg, doc, lo, hi): least and largest diagonal of shared n-grams of every pair that has one.

    grams: (seg, spos, gram) to be used in place of all n-grams of the segments.
    """
    s = segments.select("seg", F.posexplode(_ngrams(F.col("stoks"), n)).alias("spos", "gram")) if grams is None else grams
    d = transcripts.select("doc", F.posexplode(_ngrams(F.col("toks"), n)).alias("dpos", "gram"))
    weight = s.agg(F.sum(F.octet_length("gram") + ROW_BYTES)).first()[0] or 0
    s = F.broadcast(s) if weight <= BROADCAST_BYTES else s
    diagonal = F.col("dpos") - F.col("spos")
    return d.join(s, "gram").groupBy("seg", "doc").agg(F.min(diagonal).alias("lo"), F.max(diagonal).alias("hi"))


def _text(tokens: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(tokens, start + 1, length), " ")


def _span() -> tuple[Column, Column]:
    """Least and largest start of the coarse windows of a pair (w, lo, hi, n)."""
    last = F.greatest(F.col("n") - F.col("w"), F.lit(0))
    first = F.least(F.greatest(F.col("lo") - F.col("w"), F.lit(0)), last)
    return first, F.greatest(F.least(F.col("hi") + F.col("w"), last), first)


def pairs(segments: DataFrame, transcripts: DataFrame, margin: int = MARGIN, grams: DataFrame | None = None, near: DataFrame | None = None) -> DataFrame:
    """Anchored pairs: seg, doc, asr, w (tokens of the segment), lo, hi, n (tokens of the transcript), band, off.

    The band is the part of the transcript that the searches around the anchors read, with a margin for the
    fine one; it begins at token off.  No later row carries a whole transcript.  Pairs are found once, however often they
    are used, and dealt to tasks of their own, as the searches cost far more than the rows weigh.  near: what nearby
    gave for these, where it is at hand.
    """
    transcripts = nearby(segments, transcripts) if near is None else near
    found = anchors(segments, transcripts, grams=grams)
    whole = found.join(segments.select("seg", "asr", F.size("stoks").alias("w")), "seg").join(
        transcripts.select("doc", "toks", F.size("toks").alias("n")), "doc")
    first, end = _span()
    off = F.greatest(first - margin, F.lit(0)).cast("int")
    band = F.slice("toks", off + 1, (end + F.col("w") + 2 * margin).cast("int") - off)
    paired = whole.select("seg", "doc", "asr", "w", "lo", "hi", "n", off.alias("off"), band.alias("band"))
    return cut(paired).repartition(parts(paired), "seg", "doc")


def at(start: Column, length: Column) -> Column:
    """Text of a pair's transcript from token start on, read in its band."""
    return _text(F.col("band"), start - F.col("off"), length)


def anchored() -> Column:
    """Start of a pair's window at its first anchor."""
    return F.greatest(F.least("lo", F.col("n") - F.col("w")), F.lit(0))


def coarse(paired: DataFrame, top: int = TOP) -> DataFrame:
    """The best windows of each pair: steps of half a window over the anchored band, ranked within the pair's row."""
    step = F.greatest(F.floor(F.col("w") / 2), F.lit(1))
    first, end = _span()
    starts = F.sequence(first.cast("int"), end.cast("int"), step.cast("int"))
    scored = F.transform(starts, lambda p: F.struct(cer(F.col("asr"), at(p, F.col("w"))).alias("cer"), p.alias("pos")))
    ranked = paired.select("*", F.posexplode(F.slice(F.array_sort(scored), 1, top)).alias("rank", "window"))
    return ranked.withColumns({"rank": F.col("rank") + 1, "pos": F.col("window.pos"), "cer": F.col("window.cer")}).drop("window")


_FOUND = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cer", pa.float64())])


def least(asr: str, text: str, first: int, starts: int, lengths: range) -> dict | None:
    """Best of the first `starts` tokens of text as start, with one of the lengths: start (first is that of text), end and cer."""
    tokens = text.split(" ") if text else []
    places = list(accumulate((len(t) + 1 for t in tokens), initial=0))
    limit = math.ceil(len(asr) * GLOBAL_CER)
    at = range(min(starts, max(len(tokens) - lengths[0] + 1, 0)))
    if not at:
        return None
    spans, pattern = [range(s + lengths[0], min(s + lengths[-1], len(tokens)) + 1) for s in at], Pattern(asr)
    found = pattern.nearest(text, places, at, spans, limit)
    if found is None:
        table = pattern.band(text, [places[s] for s in at], [[places[e] - 1 for e in es] for es in spans])
        found = [(d, s, e) for s, es, row in zip(at, spans, table, strict=True) for e, d in zip(es, row, strict=True)]
    d, s, e = min(found, default=(limit + 1, 0, 0))
    return {"start": first + s, "end": first + e, "cer": d / max(len(asr), 1)} if d <= limit else None


def _least(asr: pa.Array, text: pa.Array, first: pa.Array, starts: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    rows = zip(asr.to_pylist(), text.to_pylist(), first.to_pylist(), starts.to_pylist(), low.to_pylist(), high.to_pylist(), strict=True)
    return pa.array([least(a, t, f, s, range(lo, hi + 1)) for a, t, f, s, lo, hi in rows], _FOUND)


def fine(regions: DataFrame, margin: int = MARGIN) -> DataFrame:
    """Per region, the start within the margin and the length within the margin with the least cer; ties: start, then length.

    Lengths are at least 1 and starts at least 0; a region whose best is beyond GLOBAL_CER has no row.  All starts and
    lengths of a region come from one sweep over its text, in the row.
    """
    n, w, pos = F.col("n"), F.col("w"), F.col("pos")
    first = F.greatest(pos - margin, F.lit(0))
    last = F.least(pos + margin, n - 1)
    text = at(first, (F.least(last + w + margin, n) - first).cast("int"))
    sweep = F.arrow_udf(_least, "struct<start:int,end:int,cer:double>")
    found = regions.where(last >= first).withColumn("found", sweep(
        F.col("asr"), text, first.cast("int"), (last - first + 1).cast("int"), F.greatest(w - margin, F.lit(1)).cast("int"), (w + margin).cast("int")))
    return found.where("found IS NOT NULL").select("seg", "doc", "rank", "found.start", "found.end", "found.cer")


def best(fined: DataFrame, paired: DataFrame) -> DataFrame:
    """One match per pair with the stage that accepted it; without one, the anchor itself at cer of its window."""
    w = Window.partitionBy("seg", "doc").orderBy("cer", "start", "end")
    top = fined.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r", "rank")
    stage = F.when(F.col("cer") <= REGION_CER, "region").when(F.col("cer") <= GLOBAL_CER, "global").otherwise("fallback")
    anchor = anchored()
    back = paired.select("seg", "doc", anchor.alias("b_start"), (anchor + F.col("w")).alias("b_end"),
                         cer(F.col("asr"), at(anchor, F.col("w"))).alias("b_cer"))
    joined = back.join(top, ["seg", "doc"], "left")
    missing = F.col("cer").isNull()
    return joined.select(
        "seg", "doc", F.coalesce("start", "b_start").alias("start"), F.coalesce("end", "b_end").alias("end"),
        F.coalesce("cer", "b_cer").alias("cer"), F.when(missing, "fallback").otherwise(stage).alias("stage"),
    )


def unmatched(segments: DataFrame, matched: DataFrame) -> DataFrame:
    """Segments without a match in any transcript, as rows (seg, stage)."""
    return segments.join(matched.select("seg").distinct(), "seg", "left_anti").select("seg", F.lit("unmatched").alias("stage"))
