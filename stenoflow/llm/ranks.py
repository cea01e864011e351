"""Positions of rows in the order of their group, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stenoflow.llm import common as C

#: Bytes that a row of the offsets counts when it is weighed for a broadcast.
OFFSET_BYTES = 128


def ranked(df: DataFrame, by: list[str], order: list[str], to: str = "rank", total: str = "total") -> DataFrame:
    """df with each row's place (from 0) in its group `by`, in ascending `order` (nulls first), and the group's size.

    The rows are sorted by range over all groups at once and written; a group's offset in a
    partition is the sum of its rows in the partitions before, so a window sees one row for each
    group and partition.  A key that repeats is split by the row's place in its file.  Columns of
    `by` hold no nulls.  df should be a written table: the range partitioning reads it twice.
    """
    rows = df.withColumn("_at", F.monotonically_increasing_id())
    keys = [*by, *order, "_at"]
    rows = C.cut(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_at").withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    heads = rows.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = C.cut(heads.select(
        *by, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(*by)).alias(total),
    ))
    small = C.within_bytes(heads.count(), OFFSET_BYTES, 16 << 20)
    joined = rows.join(F.broadcast(heads) if small else heads, [*by, "_part"])
    return joined.withColumn(to, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
