"""Mixing of sources to target weights along a time-varying curriculum.

Every source has a weight (its share of the mix) and a schedule: knots of a piecewise
linear rate over training progress 0 to 1.  Integrating the rate gives the share of the
source's tokens that is due by any time; inverting that integral at a document's place in
its source's token stream gives the document's training position.  Documents are then
range-sorted by position.

Targets stop at `repeats` times a source's size, the excess is shared out again by weight:
the solution is one level with target = min(cap, level x weight), found by sorting sources
by cap / weight.  A source with a target above its size is read in several passes.

A document's place is the running sum of sizes in the order of md5(key).  The sum is taken
in two steps, within hash buckets and over bucket totals, so that a source with a third of
all rows is spread over many tasks; only the table of sources (checked size) is broadcast.

Defined cases: a null text has size 0 and is taken 0 words; a null source is one source,
last in order; equal keys keep the order of their sizes; an empty table gives no rows;
rows that are repeated are separate rows; other columns are dropped by `plan` (which
returns its own) and kept by `mix`, where a column named like a result is replaced.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stenoflow.llm import common as C

WORD = r"[^\x20\x09-\x0D]+"
#: A source is repeated at most this often.
REPEATS = 3
#: Rows of a source per bucket of the running sum, about.
BUCKET_ROWS = 4_000
#: Rates at progress 0, 1/2 and 1 of the default schedules, dealt to sources in turn:
#: easy sources fade out, the next keep level, the last fade in.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (0.5, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weight(rank: Column) -> Column:
    """1, 2, 3, 1, 2, 3, ... by the rank of the source, from 1."""
    return (F.pmod(rank - 1, F.lit(3)) + 1).cast("double")


def _knots(rank: Column) -> Column:
    table = F.array(
        *[
            F.array(*[F.struct(F.lit(u).alias("u"), F.lit(w).alias("w")) for u, w in knots])
            for knots in SCHEDULES
        ]
    )
    return F.element_at(table, (F.pmod(rank - 1, F.lit(len(SCHEDULES))) + 1).cast("int"))


def _segments(knots: Column) -> Column:
    """Per stretch between knots: its start, rate, slope, and the normalised integral before it."""
    n = F.size(knots) - 1
    area = lambda a, b: (b["u"] - a["u"]) * (a["w"] + b["w"]) / 2
    stretches = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            F.element_at(knots, i).alias("a"), F.element_at(knots, i + 1).alias("b")
        ),
    )
    total = F.aggregate(stretches, F.lit(0.0), lambda s, x: s + area(x["a"], x["b"]))
    return F.transform(
        stretches,
        lambda x, i: F.struct(
            x["a"]["u"].alias("u"),
            x["b"]["u"].alias("to"),
            (x["a"]["w"] / total).alias("rate"),
            ((x["b"]["w"] - x["a"]["w"]) / (x["b"]["u"] - x["a"]["u"]) / total).alias("slope"),
            (
                F.aggregate(F.slice(stretches, 1, i), F.lit(0.0), lambda s, y: s + area(y["a"], y["b"]))
                / total
            ).alias("done"),
        ),
    )


def progress_at(segments: Column, share: Column) -> Column:
    """Training progress at which the given share of a source's tokens is due."""
    reached = F.filter(segments, lambda s: s["done"] <= share)
    s = F.element_at(reached, -1)
    left = share - s["done"]
    root = F.sqrt(F.greatest(s["rate"] * s["rate"] + 2 * s["slope"] * left, F.lit(0.0)))
    # the stable form of the quadratic's root holds for a slope of 0 as well
    step = F.when(left <= 0, 0.0).otherwise(2 * left / (s["rate"] + root))
    return F.least(s["u"] + step, s["to"])


def targets(sizes: DataFrame, *, repeats: int = REPEATS) -> DataFrame:
    """(source, rank, source_size, target, segments) of a (source, size) table."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("rank", F.row_number().over(by_code_point)).withColumn(
        "w", cyclic_weight(F.col("rank"))
    )
    cap = (repeats * F.col("source_size")).cast("double")
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    levelled = (
        ranked.withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
        )
        # the first source in this order whose cap reaches the level, and all after it, share that level
        .withColumn("open", F.col("cap") >= F.col("level") * F.col("w"))
        .withColumn("final", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
    )
    return levelled.select(
        "source",
        "rank",
        "source_size",
        F.when(F.col("open"), F.col("final") * F.col("w")).otherwise(F.col("cap")).alias("target"),
        _segments(_knots(F.col("rank"))).alias("segments"),
    )


def plan(df: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per row of df: key, source, size, source_size, target, taken, passes, position.

    `passes` is how often the row is taken, `positions` the training position of each.
    """
    sizes = C.cut(
        df.select(
            F.col(f"`{key}`").alias("key"),
            F.col(f"`{source}`").cast("string").alias("source"),
            word_count(F.col(f"`{text}`").cast("string")).alias("size"),
        ).withColumn("order", F.md5(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary")))
    )
    sources = C.cut(targets(sizes))
    n_rows, n_sources = sizes.count(), sources.count()
    buckets = max(1, min(1 << 20, n_rows // BUCKET_ROWS))
    digits = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    dealt = sizes.withColumn("bucket", F.floor(digits * buckets / F.lit(float(1 << 32))).cast("int"))
    totals = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("inside"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("inside").over(earlier), F.lit(0)))
    small = C.within_bytes(n_sources * buckets, 64)
    around = lambda t: F.broadcast(t) if small else t
    o, s = offsets.alias("o"), sources.alias("s")
    placed = (
        dealt.alias("d")
        .join(
            around(o),
            F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.bucket") == F.col("o.bucket")),
        )
        .join(F.broadcast(s) if C.within_bytes(n_sources, 512) else s, F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.*", "o.offset", "s.source_size", "s.target", "s.segments")
    )
    in_bucket = (
        Window.partitionBy("source", "bucket")
        .orderBy("order", "size", "key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begin = F.col("offset") + F.coalesce(F.sum("size").over(in_bucket), F.lit(0))
    full = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    middle = F.col("begin") + F.col("size") / 2
    last = (F.col("size") > 0) & (middle < F.col("target") - F.col("full") * F.col("source_size"))
    share = lambda p: (p * F.col("source_size") + middle) / F.greatest(F.col("target"), F.lit(1.0))
    return (
        placed.withColumn("begin", begin)
        .withColumn("full", full)
        .withColumn("passes", F.when(F.col("size") == 0, 0).otherwise(F.col("full") + last.cast("long")).cast("int"))
        .withColumn(
            "positions",
            F.when(
                F.col("passes") > 0,
                F.transform(
                    F.sequence(F.lit(0), F.col("passes") - 1),
                    lambda p: F.round(progress_at(F.col("segments"), F.least(share(p), F.lit(1.0))), 9),
                ),
            ).otherwise(F.array().cast("array<double>")),
        )
        .select(
            "key",
            "source",
            "size",
            "source_size",
            F.round("target", 6).alias("target"),
            (F.col("size") * F.col("passes")).alias("taken"),
            "passes",
            "positions",
        )
    )


def mix(
    df: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """Rows of df in training order, a row for each time it is taken.

    Adds `epoch` (0 for a row's first time) and `position`; rows that are not taken go.
    """
    taken = plan(df, key=key, source=source, text=text).where("passes > 0")
    # equal rows of the plan are interchangeable, so a key that is repeated is joined once
    per_key = C.cut(
        taken.groupBy("key", "source", "size")
        .agg(F.sort_array(F.flatten(F.collect_list("positions"))).alias("p"), F.count("*").alias("n"))
    )
    small = C.within_bytes(per_key.count(), 200)
    # the row is one column, so its names meet no other
    kept = [c for c in df.columns if c.lower() not in ("epoch", "position")]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{key}`").alias("k"),
        F.col(f"`{source}`").cast("string").alias("s"), F.col(f"`{text}`").cast("string").alias("t"),
    ).withColumn("z", word_count(F.col("t")))
    joined = rows.join(
        F.broadcast(per_key) if small else per_key,
        F.col("k").eqNullSafe(F.col("key")) & F.col("s").eqNullSafe(F.col("source")) & (F.col("z") == F.col("size")),
    )
    one = Window.partitionBy("k", "s", "z").orderBy("t")
    # only keys that are not unique need their positions dealt out, so other texts are not shuffled for it
    alone = joined.where("n = 1").withColumn("at", F.lit(0))
    shared = joined.where("n > 1").withColumn("at", F.row_number().over(one) - 1)
    mine = F.expr("filter(transform(p, (x, i) -> struct(i as i, x as x)), e -> e.i % n = at)")
    dealt = alone.unionByName(shared).select("row", "k", F.posexplode(mine).alias("epoch", "e"))
    return dealt.orderBy(F.col("e.x"), "k", "epoch").select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept], "epoch", F.col("e.x").alias("position")
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, in training order."""
    docs = C.table(spark, sf_dir, "documents")
    return (
        plan(docs)
        .select(
            F.col("key").alias("doc_id"),
            "size",
            "source_size",
            "target",
            "taken",
            "passes",
            F.try_element_at("positions", F.lit(1)).alias("position"),
        )
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS o
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, CAST((rank - 1) % 3 + 1 AS DOUBLE) AS w, CAST(3 * source_size AS DOUBLE) AS cap FROM r),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0))
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0)) AS level
  FROM w
  WINDOW b AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, rank, source_size,
         CASE WHEN cap >= level * w
              THEN w * max(CASE WHEN cap >= level * w THEN level END) OVER () ELSE cap END AS target
  FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rank,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.size, d.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2 AS middle,
         CAST(floor(t.target / greatest(t.source_size, 1)) AS BIGINT) AS f
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (
  SELECT *, CASE WHEN size = 0 THEN 0
                 ELSE f + CASE WHEN middle < target - f * source_size THEN 1 ELSE 0 END END AS passes,
         least(middle / greatest(target, 1.0), 1.0) AS q,
         CASE (rank - 1) % 3 WHEN 0 THEN -1.0 WHEN 1 THEN 0.0 ELSE 1.0 END AS slope,
         CASE (rank - 1) % 3 WHEN 0 THEN 1.5 WHEN 1 THEN 1.0 ELSE 0.5 END AS rate
  FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target,
       CAST(size * passes AS BIGINT) AS taken, CAST(passes AS INTEGER) AS passes,
       CASE WHEN passes > 0 THEN
         round(CASE WHEN slope = 0 THEN q
               ELSE 2 * q / (rate + sqrt(greatest(rate * rate + 2 * slope * q, 0.0))) END, 9) END AS position
FROM n
"""
