"""Status and throughput over event streams; the functions take batch frames as well."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stenoflow.operators import status as ST


def throughput(events: DataFrame, *, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(hour, n, volume) per event-time window; a stream drops events later than `late`."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", window).alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("volume")).select(
        F.col("w.start").alias("hour"), "n", "volume")


def once(events: DataFrame, keys: list[str], *, late: str = "1 hour") -> DataFrame:
    """First event of each key; a stream forgets keys after `late`."""
    if events.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


class LatestStatus(StatefulProcessor):
    """Keeps the latest status of an item; events that come out of order change nothing.

    ttl_ms: processing time after its last event when an item is forgotten.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType().add("ts", T.TimestampType()).add("event_id", T.LongType()).add("status", T.StringType()).add("attempts", T.LongType())
        self.latest = handle.getValueState("latest", schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        ts = event_id = status = None
        attempts = 0
        if self.latest.exists():
            ts, event_id, status, attempts = self.latest.get()
        for part in rows:
            for r in part.itertuples():
                if r.status not in ST.STATES:
                    continue
                attempts += r.status == "downloading"
                if ts is None or (r.ts, r.event_id) > (ts, event_id):
                    ts, event_id, status = r.ts.to_pydatetime(), int(r.event_id), r.status
        if ts is not None:
            self.latest.update((ts, event_id, status, attempts))
            yield pd.DataFrame({"item": [key[0]], "ts": [ts], "status": [status], "attempts": [attempts]})

    def close(self) -> None:
        pass


def latest_stream(events: DataFrame, *, ttl_seconds: int | None = None) -> DataFrame:
    """Updates of each item's latest status; with a time to live, items without events are forgotten."""
    schema = "item long, ts timestamp, status string, attempts long"
    state = LatestStatus(None if ttl_seconds is None else 1000 * ttl_seconds)
    return events.groupBy("item").transformWithStateInPandas(state, schema, "Update", "none" if ttl_seconds is None else "ProcessingTime")


def upsert_to(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps a Parquet snapshot of latest statuses: every micro-batch writes the next version.

    The version before stays, for a batch that is run again; older ones are deleted.
    """
    spark = events.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        new = ST.legal(batch).select("item", "ts", "event_id", "status")
        if batch_id:
            new = new.unionByName(spark.read.parquet(f"{path}/version={batch_id - 1}"))
        at = F.struct("ts", "event_id")
        new.groupBy("item").agg(F.max("ts").alias("ts"), F.max_by("event_id", at).alias("event_id"), F.max_by("status", at).alias("status")).write.mode(
            "overwrite").parquet(f"{path}/version={batch_id}")
        if batch_id > 1:
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version={batch_id - 2}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
