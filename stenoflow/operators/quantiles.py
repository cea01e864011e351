"""Exact quantiles by selection: histograms that close in on the wanted ranks.

A first pass counts values by logarithmic bucket; later ones split only the bucket that holds a wanted rank,
between its least and greatest value, until one value is left.  Rows are counted where they lie, so
what meets in a task is a row for each bucket of a group, whatever the number of rows or of different values.
A quantile lies between two ranks and is interpolated linearly.

Defined cases: nulls and NaN are no values; a group without values has no row; infinite values are values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stenoflow.operators.lineage import cut

#: Buckets of a factor of two in the first pass, and of a bucket in a later one.
FIRST, LATER = 64, 4096
#: Targets are broadcast up to this number; a target takes fewer than 200 bytes.
TARGETS = 100_000


def _logarithmic(value: Column) -> Column:
    """Ascending numbers of buckets of ascending values."""
    size = F.floor(F.log2(F.abs(value)) * FIRST) + 100_000  # the least double has more than -69,000
    return F.when(value == 0, F.lit(0).cast("long")).when(value == F.lit(float("inf")), F.lit(1 << 40)).when(
        value == F.lit(float("-inf")), F.lit(-(1 << 40))).when(value > 0, size).otherwise(-size)


def _found(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Per target, the bucket that holds its rank: its bounds and the rows before it."""
    w = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_off") + F.coalesce(F.sum("_n").over(w), F.lit(0))
    held = counted.withColumn("_off", before)
    return held.where((F.col("_off") <= F.col("_rank")) & (F.col("_rank") < F.col("_off") + F.col("_n"))).select(*keys, "_off", "_lo", "_hi")


def quantiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, share, quantile): exact, linearly interpolated quantiles of each group."""
    groups = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    rows = rows.select(*groups, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counted = cut(rows.groupBy(*groups, _logarithmic(F.col("_v")).alias("_bucket")).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    at = (F.col("_total") - 1) * F.col("share")
    totals = counted.groupBy(*groups).agg(F.sum("_n").alias("_total")).withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    ranks = totals.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at))))).select(*groups, "share", "_rank")
    keys = [*groups, "share", "_rank"]
    same = [F.col(f"c.{g}").eqNullSafe(F.col(f"t.{g}")) for g in groups]
    met = counted.alias("c").join(cut(ranks).alias("t"), same).select("t.*", "_bucket", "_n", "_lo", "_hi", F.lit(0).cast("long").alias("_off"))
    targets, done = cut(_found(met, keys)), []
    while True:
        done.append(targets.where("_lo = _hi"))
        wanted = targets.where("_lo < _hi")
        number = wanted.count()
        if not number:
            break
        inside = [F.col(f"r.{g}").eqNullSafe(F.col(f"t.{g}")) for g in groups] + [F.col("_v").between(F.col("_lo"), F.col("_hi"))]
        share = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * LATER)
        side = F.broadcast(wanted) if number <= TARGETS else wanted
        split = rows.alias("r").join(side.alias("t"), inside).select("t.*", "_v", F.least(share, F.lit(LATER - 1)).alias("_bucket"))
        counted = split.groupBy(*keys, "_off", "_bucket").agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        targets = cut(_found(counted, keys))
    ends = done[0]
    for d in done[1:]:
        ends = ends.unionByName(d)
    both = ends.groupBy(*groups, "share").agg(F.min_by("_lo", "_rank").alias("_a"), F.max_by("_lo", "_rank").alias("_b"))
    size = cut(totals.select(*groups, "share", at.alias("_at")))
    same = [F.col(f"x.{g}").eqNullSafe(F.col(f"s.{g}")) for g in [*groups, "share"]]
    joined = both.alias("x").join(size.alias("s"), same).select("x.*", "_at")
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_at") - F.floor("_at"))
    return joined.select(*by, "share", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(between).alias("quantile"))
