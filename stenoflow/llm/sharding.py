"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts are a group, which goes to one shard as a whole.  Groups, largest first, enter
the shard whose remaining capacity is tightest among those that hold them; remaining
capacities are kept in a balanced tree.  The capacity is the least with which the wanted number of
shards is enough (`balance`); with a given capacity, the number of shards is what is minimised (`pack`).  A
group that is larger than the mean of what is left gets a shard of its own first, so it sets no
capacity for the others.

The plan is made of a bounded number of items, whatever the number of groups.  Groups of at least one
GRAIN-th of a mean shard are items themselves; there can be no more than shards * GRAIN of them.  Smaller
groups are dealt by their hash to shards * GRAIN bundles, and a bundle is an item of the sum of
its groups.  The items pass through the driver and come back as a broadcast; rows do not.

Within a shard, slots count from 0 in the order of the ids.

Defined cases: null texts are one group, of no bytes besides the overhead, and empty texts another;
equal rows get slots of their own, in any order; null ids come first; a group that is larger than a
mean shard makes its shard larger, as a group is not divided; an empty table has no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stenoflow.llm import common as C
from stenoflow.llm.ranks import ranked

SHARDS = 40
#: Bytes that a row takes beside its text.
OVERHEAD = 16
#: Items of a mean shard, at most, that are planned one by one.
GRAIN = 500
LEAF = 32


class Capacities:
    """Remaining capacities (capacity, shard) in a balanced tree of two levels.

    Leaves are sorted and hold up to LEAF entries; a full one is split in two and an empty one goes.
    """

    def __init__(self) -> None:
        self._leaves: list[list[tuple[int, int]]] = []
        self._greatest: list[tuple[int, int]] = []

    def add(self, capacity: int, shard: int) -> None:
        entry = capacity, shard
        if not self._leaves:
            self._leaves, self._greatest = [[entry]], [entry]
            return
        k = min(bisect_left(self._greatest, entry), len(self._leaves) - 1)
        leaf = self._leaves[k]
        leaf.insert(bisect_right(leaf, entry), entry)
        if len(leaf) > LEAF:
            half = len(leaf) // 2
            self._leaves[k : k + 1] = [leaf[:half], leaf[half:]]
            self._greatest[k : k + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self._greatest[k] = leaf[-1]

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least capacity that holds size, taken out; None if there is none."""
        least = size, -1
        k = bisect_left(self._greatest, least)
        if k == len(self._leaves):
            return None
        leaf = self._leaves[k]
        entry = leaf.pop(bisect_left(leaf, least))
        if leaf:
            self._greatest[k] = leaf[-1]
        else:
            del self._leaves[k], self._greatest[k]
        return entry


def pack(sizes: Sequence[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Best fit of sizes, given in descending order, into shards of a capacity: each one's shard.

    A size above the capacity gets a shard of its own.  None if more than `most` shards are needed.
    """
    left, out, opened = Capacities(), [], 0
    for size in sizes:
        found = left.tightest(size)
        if found is None:
            if opened == most:
                return None
            found = max(capacity, size), opened
            opened += 1
        left.add(found[0] - size, found[1])
        out.append(found[1])
    return out


def balance(sizes: Sequence[int], shards: int) -> list[int]:
    """Best fit of sizes, in descending order, into a number of shards with the least capacity that is enough."""
    own, rest = 0, sum(sizes)
    # what exceeds the mean of the rest stands alone
    while own < len(sizes) and own < shards - 1 and sizes[own] * (shards - own) >= rest:
        rest -= sizes[own]
        own += 1
    others, bins = sizes[own:], shards - own
    if not others:
        return list(range(own))
    low = max(-(-rest // bins), others[0])
    high = low
    best = pack(others, high, bins)
    while best is None:
        low, high = high + 1, high + max(high // 64, 1)
        best = pack(others, high, bins)
    while low < high and high - low > high // 100_000:
        mid = (low + high) // 2
        found = pack(others, mid, bins)
        if found is None:
            low = mid + 1
        else:
            best, high = found, mid
    return [*range(own), *(own + b for b in best)]


def plan(items: Iterable[tuple[object, int]], shards: int) -> dict[object, int]:
    """Shards of items (name, size): descending sizes, equal ones by name."""
    ordered = sorted(items, key=lambda x: (-x[1], str(x[0])))
    return dict(zip([k for k, _ in ordered], balance([s for _, s in ordered], shards), strict=True))


def assign(df: DataFrame, *, key: str = "doc_id", text: str = "text", shards: int = SHARDS, grain: int = GRAIN) -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row."""
    spark = df.sparkSession
    t = F.col(f"`{text}`").cast("string")
    body = F.coalesce(t, F.lit("")).cast("binary")
    rows = C.cut(df.select(
        F.col(f"`{key}`").alias("id"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("crc"),
        # a null is no hash of any text
        F.coalesce(F.unhex(F.sha2(t.cast("binary"), 256)), F.lit(b"")).alias("group")))
    bundle = lambda: F.pmod(F.xxhash64("group"), F.lit(shards * grain)).cast("int")
    groups = C.cut(rows.groupBy("group").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    item = F.col("bytes") * (shards * grain) >= total  # at most shards * grain groups
    alone = groups.where(item).select("group", "bytes")
    dealt = groups.where(~item).groupBy(bundle().alias("bundle")).agg(F.sum("bytes").alias("bytes"))
    items = [(bytes(g), n) for g, n in alone.collect()] + [(b, n) for b, n in dealt.collect()]
    placed = plan(items, shards)
    of_group = [(bytearray(k), v) for k, v in placed.items() if isinstance(k, bytes)]
    of_bundle = [(k, v) for k, v in placed.items() if isinstance(k, int)]
    found = rows.join(F.broadcast(spark.createDataFrame(of_group, "`group` binary, alone int")), "group", "left").withColumn("bundle", bundle())
    found = found.join(F.broadcast(spark.createDataFrame(of_bundle, "bundle int, dealt int")), "bundle", "left")
    placed_rows = found.select("id", "size", "crc", F.coalesce("alone", "dealt").alias("shard"))
    slots = ranked(placed_rows, ["shard"], ["id", "crc"], to="slot")
    return slots.select(F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes; equal texts stay together."""
    rows = assign(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
