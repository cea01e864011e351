"""Cutting recordings into segments along silences, overlapping speech and changes of speaker.

From a cursor, in this order: a long silence at the cursor is skipped; speech of several speakers at
once within reach is skipped up to its end; a change of speaker within reach ends the segment; else
the segment ends in the middle of the longest silence at least `least` and at most `most` seconds
ahead, or after `most` seconds.  Everything is one fold over three sorted lists with a cursor into
each, so a step sees only what lies within its reach.  A recording is one group, whose rows are bounded
by its playing time; recordings are dealt to tasks by Spark.  Batch and stream share the fold.

Defined cases: without labels nothing overlaps or changes; intervals that touch do not overlap;
intervals without length and null times are left out; recordings without duration have no segments; equal rows count once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the cursor is moved on by behind overlapping speech, in seconds.
BEHIND = 1e-6
OUT = "video string, seg_idx int, start double, end double"


@dataclass(frozen=True)
class Rules:
    """Bounds of a segment in seconds; inside: a silence in which the cursor stands is skipped like one that begins there."""

    least: float = 10.0
    most: float = 20.0
    inside: bool = True


def together(labels: Sequence[tuple[float, float, str]]) -> list[tuple[float, float]]:
    """Sorted intervals in which labels (start, end, label), sorted, overlap others."""
    until: dict[str, float] = {}
    out: list[tuple[float, float]] = []
    for start, end, label in labels:
        others = max((e for x, e in until.items() if x != label), default=start)
        if others > start:
            last = min(end, others)
            if out and start <= out[-1][1]:
                out[-1] = out[-1][0], max(out[-1][1], last)
            else:
                out.append((start, last))
        until[label] = max(until.get(label, end), end)
    return out


def fold(cur: float, known: float, closed: bool, silences: Sequence[tuple], labels: Sequence[tuple], rules: Rules) -> tuple[list[tuple[float, float]], float]:
    """Segments (start, end) that are settled by sorted silences and labels up to `known`, and the cursor after them.

    An open recording is cut only where everything within reach of the cursor is known; a closed one to its end, `known`.
    """
    overlaps = together(labels)
    i = j = k = 0
    out = []
    while cur < known if closed else cur + rules.most <= known:
        lo, hi = cur + rules.least, cur + rules.most
        while i < len(silences) and silences[i][1] <= cur:
            i += 1
        near, m = [], i
        while m < len(silences) and silences[m][0] < hi:
            if silences[m][1] > cur:
                near.append(silences[m])
            m += 1
        if rules.inside:
            longest = max(((min(e, hi) - max(s, cur), -max(s, cur), min(e, hi)) for s, e in near), default=None)
            skip = longest[2] if longest and longest[1] == -cur and longest[0] > rules.least else None
        else:
            skip = next((e for s, e in near if s == cur and e - s > rules.least), None)
        if skip is not None:
            cur = skip
            continue
        while j < len(overlaps) and overlaps[j][1] <= cur:
            j += 1
        if j < len(overlaps) and overlaps[j][0] < hi:
            cur = overlaps[j][1] + BEHIND
            continue
        while k < len(labels) and labels[k][1] <= cur:
            k += 1
        heard, m = [], k
        while m < len(labels) and labels[m][0] < hi:
            if labels[m][1] > cur:
                heard.append((max(labels[m][0], cur), min(labels[m][1], hi), labels[m][2]))
            m += 1
        first = min(heard)[2] if heard else None
        cut = min((s for s, _, x in heard if x != first and s > cur), default=None)
        if cut is None:
            inside = max(((min(e, hi) - max(s, lo), -max(s, lo), min(e, hi)) for s, e in near if e > lo), default=None)
            cut = (-inside[1] + inside[2]) / 2 if inside else hi
        out.append((cur, min(cut, known) if closed else cut))
        cur = cut
    return out, cur


def _lists(column: pa.ListArray, *names: str) -> list[list[tuple]]:
    """The rows of a list of structs, as tuples."""
    rows = list(zip(*[column.values.field(n).to_pylist() for n in names], strict=True))
    return [rows[a:b] for a, b in pairwise(column.offsets.to_pylist())]


def segment(silences: DataFrame, extents: DataFrame, labels: DataFrame | None = None, *, rules: Rules = Rules()) -> DataFrame:
    """(video, seg_idx, start, end) from silences (video, start, end), extents (video, duration) and labels (video, start, end, label)."""
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, label: Column) -> DataFrame:
        return df.where("`end` > start").select(
            "video", F.lit(kind).alias("kind"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), label.alias("label"))

    every = rows(silences, "silence", none)
    if labels is not None:
        every = every.unionByName(rows(labels.where("label IS NOT NULL"), "label", F.col("label").cast("string")))
    every = every.unionByName(rows(extents.select("video", F.lit(0.0).alias("start"), F.col("duration").alias("end")), "extent", none))
    of = lambda kind, *cols: F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.struct(*cols))))
    listed = every.groupBy("video").agg(
        F.max(F.when(F.col("kind") == "extent", F.col("end"))).alias("duration"), of("silence", "start", "end").alias("quiet"),
        of("label", "start", "end", "label").alias("heard"))

    def cut(duration: pa.Array, quiet: pa.Array, heard: pa.Array) -> pa.Array:
        videos = zip(duration.to_pylist(), _lists(quiet, "start", "end"), _lists(heard, "start", "end", "label"), strict=True)
        made = [fold(0.0, d, True, q, h, rules)[0] for d, q, h in videos]
        spans = pa.array([dict(zip(("start", "end"), x, strict=True)) for m in made for x in m], pa.struct([("start", pa.float64()), ("end", pa.float64())]))
        return pa.ListArray.from_arrays(pa.array(accumulate((len(m) for m in made), initial=0), pa.int32()), spans)

    found = F.arrow_udf(cut, "array<struct<start:double,end:double>>")("duration", "quiet", "heard")
    return listed.where("duration IS NOT NULL").select("video", F.posexplode(found).alias("seg_idx", "s")).select("video", "seg_idx", "s.start", "s.end")
