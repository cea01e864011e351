"""Keyed tables that micro-batches change in place, a hash bucket at a time.

A bucket is a Parquet folder that is never changed; a batch writes new folders for the buckets it
touches and then, by one rename, a pointer that names the folder of every bucket and the
batch.  Several tables have one pointer, so they change together or not at all.  Readers see the
latest pointer.  A batch that the pointer already holds changes nothing, so a batch that is run again is
counted once.  Folders that neither the latest pointer nor the one before names are deleted.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stenoflow.operators import status as ST
from stenoflow.operators.lineage import cut

BUCKETS = 64


@dataclass(frozen=True)
class Table:
    """Columns of a table as DDL, and those of its key."""

    schema: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS


class Store:
    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Table]):
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._paths(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._paths(f"{self.path}/{folder}")
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _pointers(self) -> list[str]:
        return [n for n in self._names("pointers") if n.startswith("p-")]

    def pointer(self, back: int = 1) -> dict:
        """The latest pointer, or an earlier one: batch by query, and folders by table and bucket."""
        names = self._pointers()
        if len(names) < back:
            return {"batches": {}, "tables": {t: {} for t in self.tables}}
        stream = self._fs.open(self._paths(f"{self.path}/pointers/{names[-back]}"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def done(self, batch: int, query: str) -> bool:
        """Whether the pointer already holds a query's batch."""
        return self.pointer()["batches"].get(query, -1) >= batch

    def bucket(self, table: str) -> Column:
        t = self.tables[table]
        return F.pmod(F.xxhash64(*t.keys), F.lit(t.buckets)).cast("int")

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a table, or of some of its buckets."""
        folders = self.pointer()["tables"][table]
        kept = sorted(f for b, f in folders.items() if buckets is None or int(b) in buckets)
        schema = T.StructType.fromDDL(self.tables[table].schema)
        if not kept:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in kept])

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """Buckets that rows belong to, at most as many as the table has."""
        return [b for (b,) in rows.select(self.bucket(table)).distinct().collect()]

    def commit(self, changes: dict[str, DataFrame], batch: int, query: str) -> None:
        """Put whole new buckets (all their rows) in place of the old ones."""
        new = self.pointer()
        old = json.loads(json.dumps(new))
        for table, rows in changes.items():
            folder = f"{table}/{batch}-{uuid.uuid4().hex[:12]}"
            rows.withColumn("_bucket", self.bucket(table)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            for name in self._names(folder):
                if name.startswith("_bucket="):
                    new["tables"][table][name.split("=")[1]] = f"{folder}/{name}"
        new["batches"][query] = batch
        number = int(self._pointers()[-1][2:]) + 1 if self._pointers() else 0
        draft = self._paths(f"{self.path}/pointers/draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        if not self._fs.rename(draft, self._paths(f"{self.path}/pointers/p-{number:020d}")):
            raise RuntimeError("another writer has moved the pointer")
        self._forget(old, new)

    def _forget(self, *kept: dict) -> None:
        """Delete pointers before the last two, and folders that these do not name."""
        for name in self._pointers()[:-2]:
            self._fs.delete(self._paths(f"{self.path}/pointers/{name}"), False)
        named = {f for p in kept for t in p["tables"].values() for f in t.values()}
        for table in self.tables:
            for run in self._names(table):
                buckets = self._names(f"{table}/{run}")
                gone = [b for b in buckets if b.startswith("_bucket=") and f"{table}/{run}/{b}" not in named]
                if len(gone) == sum(b.startswith("_bucket=") for b in buckets):
                    self._fs.delete(self._paths(f"{self.path}/{table}/{run}"), True)
                else:
                    for b in gone:
                        self._fs.delete(self._paths(f"{self.path}/{table}/{run}/{b}"), True)


AT = "struct<ts:timestamp,event_id:bigint>"
#: Latest statuses of items, and what they add up to by group.
STATUS = {
    "items": Table(f"parliament bigint, item bigint, status string, at {AT}, first timestamp, attempts bigint, last_error string, failed_at {AT}", ("parliament", "item")),
    "totals": Table("parliament bigint, total bigint, completed bigint, failed bigint, a timestamp, b timestamp", ("parliament",), 8),
}


def _states(events: DataFrame) -> DataFrame:
    """What a batch of events says of each of its items."""
    at = F.struct("ts", "event_id")
    failed = F.when(F.col("status") == "failed", at)
    return ST.legal(events).where("ts IS NOT NULL").groupBy("parliament", "item").agg(
        F.max_by("status", at).alias("status"), F.max(at).alias("at"), F.min("ts").alias("first"),
        F.count_if(F.col("status") == "downloading").alias("attempts"), F.max_by("error", failed).alias("last_error"), F.max(failed).alias("failed_at"))


def refresh(store: Store, events: DataFrame, batch: int, query: str = "") -> None:
    """Bring a batch of events into the items' statuses and the groups' totals.

    Only buckets of items in the batch are read and written.  A group's totals change by what its changed items
    added before and add now; older events that come late change an item's counts and not its status.
    Events of unknown status or without a time change nothing.
    """
    if store.done(batch, query):
        return
    new = cut(_states(events))
    old = store.read("items", store.touched("items", new))
    both = old.withColumn("old", F.lit(1)).unionByName(new.withColumn("old", F.lit(0)))
    items = cut(both.groupBy("parliament", "item").agg(
        F.max_by("status", "at").alias("status"), F.max("at").alias("at"), F.min("first").alias("first"), F.sum("attempts").alias("attempts"),
        F.max_by("last_error", "failed_at").alias("last_error"), F.max("failed_at").alias("failed_at"),
        F.max(F.when(F.col("old") == 1, F.col("status"))).alias("before"), F.min("old").alias("same")))
    now, before = F.col("status"), F.coalesce("before", F.lit(""))
    delta = items.where("same = 0").groupBy("parliament").agg(
        F.count_if(before == "").alias("total"), F.sum((now == "completed").cast("long") - (before == "completed").cast("long")).alias("completed"),
        F.sum((now == "failed").cast("long") - (before == "failed").cast("long")).alias("failed"), F.min("first").alias("a"), F.max("at.ts").alias("b"))
    delta = cut(delta)
    totals = store.read("totals", store.touched("totals", delta)).unionByName(delta).groupBy("parliament").agg(
        F.sum("total").alias("total"), F.sum("completed").alias("completed"), F.sum("failed").alias("failed"), F.min("a").alias("a"), F.max("b").alias("b"))
    store.commit({"items": items.drop("before", "same"), "totals": totals}, batch, query)


def progress(store: Store) -> DataFrame:
    """The totals as `operators.status.progress` reports them."""
    return ST.progress(store.read("totals"))


def refresh_to(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep statuses and totals of an event stream (event_id, ts, item, parliament, status, error) up to date.

    A stream with another checkpoint is another query: events that it reads again are counted again.
    """
    spark = events.sparkSession
    store = Store(spark, path, STATUS)

    def apply(batch: DataFrame, batch_id: int) -> None:
        refresh(store, batch, batch_id, spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "")

    return events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
