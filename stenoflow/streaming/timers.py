"""Streams that act when time has passed: stages that never end, and batches that fill up or wait too long."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: States in which nothing more is expected of an item.
ENDS = ("completed", "failed")
STUCK = "item long, stage string, since timestamp, failed_at timestamp"
BATCHES = "shard long, batch_no long, pos long, record_id long, payload string"


def _ms(at: pd.Timestamp) -> int:
    return at.value // 1_000_000


class Stuck(StatefulProcessor):
    """Fails a stage that no event of its item has followed within the bound.

    State of an item is its latest event while that is not an end, with a timer at its bound, and is dropped with the end or
    the failure; so nothing stays of items that stop.  Events before the latest one change nothing.
    """

    def __init__(self, bound_ms: int):
        self.bound_ms = bound_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", T.StructType().add("ts", T.TimestampType()).add("event_id", T.LongType()).add("status", T.StringType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = self.latest.get() if self.latest.exists() else None
        before = held
        failed = []
        events = sorted((r.ts, r.event_id, r.status) for part in rows for r in part.itertuples() if not pd.isna(r.ts))
        for ts, event_id, status in events:
            if held is not None:
                since = pd.Timestamp(held[0])
                if (ts, event_id) <= (since, held[1]):
                    continue
                if _ms(ts) - _ms(since) > self.bound_ms and held[2] not in ENDS:
                    failed.append((held[2], since, since + pd.Timedelta(milliseconds=self.bound_ms)))
            held = (ts.to_pydatetime(), int(event_id), status)
        if before is not None and before[2] not in ENDS:
            self.handle.deleteTimer(_ms(pd.Timestamp(before[0])) + self.bound_ms)
        if held is not None and held[2] not in ENDS:
            self.latest.update(held)
            self.handle.registerTimer(_ms(pd.Timestamp(held[0])) + self.bound_ms)
        elif before is not None:
            self.latest.clear()
        yield from self._rows(key, failed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.latest.exists():
            ts, _, status = self.latest.get()
            since = pd.Timestamp(ts)
            if _ms(since) + self.bound_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.latest.clear()
                yield from self._rows(key, [(status, since, since + pd.Timedelta(milliseconds=self.bound_ms))])

    def _rows(self, key, failed: list[tuple]) -> Iterator[pd.DataFrame]:
        if failed:
            yield pd.DataFrame({"item": key[0], "stage": [f[0] for f in failed], "since": [f[1] for f in failed], "failed_at": [f[2] for f in failed]})

    def close(self) -> None:
        pass


def stuck_stream(events: DataFrame, *, bound_seconds: int, late: str = "10 minutes") -> DataFrame:
    """(item, stage, since, failed_at) of stages without a next event within the bound, from (item, event_id, ts, status) in time order."""
    kept = events.withWatermark("ts", late)
    return kept.groupBy("item").transformWithStateInPandas(Stuck(1000 * bound_seconds), STUCK, "Append", "EventTime")


def stuck(events: DataFrame, *, bound_seconds: int) -> DataFrame:
    """The same over a whole table, in which time has passed up to its last event."""
    w = Window.partitionBy("item").orderBy("ts", "event_id")
    until = F.col("ts") + F.make_interval(secs=F.lit(bound_seconds))
    now = F.broadcast(events.agg(F.max("ts").alias("now")))
    late = F.coalesce(F.col("next") > F.col("failed_at"), F.col("failed_at") <= F.col("now"))
    return events.where("ts IS NOT NULL").withColumns({"next": F.lead("ts").over(w), "failed_at": until}).where(~F.col("status").isin(*ENDS)).crossJoin(now).where(late).select(
        "item", F.col("status").alias("stage"), F.col("ts").alias("since"), "failed_at")


class Batches(StatefulProcessor):
    """Gives out a shard's records in batches of exactly `size`, and what is left when it has waited too long.

    State of a shard is fewer than `size` records and the number of its next batch.  Records of a
    micro-batch are taken in order of time and id, so a micro-batch that is run again gives the same batches.
    """

    def __init__(self, size: int, wait_ms: int):
        self.size, self.wait_ms = size, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", T.StructType().add("batch_no", T.LongType()).add("due", T.LongType()))
        self.held = handle.getListState("held", T.StructType().add("ts", T.TimestampType()).add("record_id", T.LongType()).add("payload", T.StringType()))

    def _state(self) -> tuple[int, int, list[tuple]]:
        number, due = self.next.get() if self.next.exists() else (0, 0)
        return number, due, [tuple(r) for r in self.held.get()] if due else []

    def _keep(self, number: int, due: int, left: list[tuple]) -> None:
        """Held records and the time they are given out at the latest; 0 without any."""
        at = _ms(pd.Timestamp(left[0][0])) + self.wait_ms if left else 0
        if due != at:
            if due:
                self.handle.deleteTimer(due)
            if at:
                self.handle.registerTimer(at)
        self.next.update((number, at))
        if left:
            self.held.put(left)
        else:
            self.held.clear()

    def _rows(self, key, given: list[tuple[int, list[tuple]]]) -> pd.DataFrame:
        flat = [(n, i, *r[1:]) for n, rows in given for i, r in enumerate(rows)]
        return pd.DataFrame({"shard": key[0], **{c: [f[i] for f in flat] for i, c in enumerate(("batch_no", "pos", "record_id", "payload"))}})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        number, due, held = self._state()
        new = sorted((r.ts.to_pydatetime(), int(r.record_id), None if pd.isna(r.payload) else r.payload) for part in rows for r in part.itertuples() if not pd.isna(r.ts))
        given = []
        for row in new:
            # what had waited too long when this one came is a batch, however the stream is cut
            if held and _ms(pd.Timestamp(row[0])) - _ms(pd.Timestamp(held[0][0])) > self.wait_ms:
                given.append((number, held))
                number, held = number + 1, []
            held = [*held, row]
            if len(held) == self.size:
                given.append((number, held))
                number, held = number + 1, []
        self._keep(number, due, held)
        if given:
            yield self._rows(key, given)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, due, held = self._state()
        if held and due <= expiredTimerInfo.getExpiryTimeInMs():
            self._keep(number + 1, 0, [])
            yield self._rows(key, [(number, held)])

    def close(self) -> None:
        pass


def batch_stream(records: DataFrame, *, size: int, wait_seconds: int = 3600, late: str = "10 minutes") -> DataFrame:
    """(shard, batch_no, pos, record_id, payload) from a stream of (shard, ts, record_id, payload) in time order; records without a time are left out."""
    kept = records.withWatermark("ts", late)
    return kept.groupBy("shard").transformWithStateInPandas(Batches(size, 1000 * wait_seconds), BATCHES, "Append", "EventTime")
