"""Bucketed stores, refreshed totals, timers and record batches against their batch twins."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from stenoflow.operators import status as ST
from stenoflow.streaming import buckets as BK
from stenoflow.streaming import status as S
from stenoflow.streaming import timers as TM

EVENTS = "event_id long, ts timestamp, item long, parliament long, status string, error string"
START = dt.datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def log(n, seed, items=12):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        status = r.choice([*ST.STATES, "odd"])
        item = r.choice([None, 0, 0, 0, *range(items)])
        rows.append((i, START + dt.timedelta(minutes=r.randrange(500)) if r.random() < 0.97 else None, item, item and item % 3, status, f"e{i}" if status == "failed" else None))
    return rows


def rollup(events):
    at = F.struct("ts", "event_id")
    latest = ST.legal(events).where("ts IS NOT NULL").groupBy("parliament", "item").agg(F.max_by("status", at).alias("status"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ST.progress(latest.groupBy("parliament").agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.min("a").alias("a"), F.max("b").alias("b")))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_totals_equal_the_rollup_after_every_batch(spark, tmp_path):
    rows, store = log(120, 3), BK.Store(spark, str(tmp_path / "s"), BK.STATUS)
    assert store.read("items").count() == 0
    for k in range(4):  # times are in no order: every batch has late events
        batch = spark.createDataFrame(rows[30 * k : 30 * k + 30], EVENTS)
        BK.refresh(store, batch, k, "q")
        before = json.dumps(store.pointer())
        BK.refresh(store, batch, k, "q")
        assert json.dumps(store.pointer()) == before
        so_far = spark.createDataFrame(rows[: 30 * k + 30], EVENTS)
        assert rows_of(BK.progress(store)) == rows_of(rollup(so_far))
        want = ST.latest(so_far.where("ts IS NOT NULL")).select("item", "status", "ts", "attempts", "last_error")
        assert rows_of(store.read("items").select("item", "status", F.col("at.ts").alias("ts"), "attempts", "last_error")) == rows_of(want)
    BK.refresh(store, spark.createDataFrame([], EVENTS), 4, "q")
    assert rows_of(BK.progress(store)) == rows_of(rollup(spark.createDataFrame(rows, EVENTS)))
    assert len(store._pointers()) == 2


def test_only_touched_buckets_are_written(spark, tmp_path):
    store = BK.Store(spark, str(tmp_path / "s"), BK.STATUS)
    every = [(i, START, i, i % 3, "pending", None) for i in range(200)]
    BK.refresh(store, spark.createDataFrame(every, EVENTS), 0)
    old = store.pointer()["tables"]
    BK.refresh(store, spark.createDataFrame([(900, START + dt.timedelta(hours=1), 7, 1, "completed", None), (901, START, 7, 1, "downloading", None)], EVENTS), 1)
    new = store.pointer()["tables"]
    changed = {t: {b for b in new[t] if new[t][b] != old[t].get(b)} for t in new}
    assert len(old["items"]) > 50 and len(changed["items"]) == 1 and len(changed["totals"]) == 1
    assert store.read("items").count() == 200
    # the folders of the pointer before are there for its readers; a third batch lets go of what only the first one named
    BK.refresh(store, spark.createDataFrame([(902, START, 7, 1, "downloading", None)], EVENTS), 2)
    gone = old["items"][next(iter(changed["items"]))]
    assert not (tmp_path / "s" / gone).exists() and store.read("items").where("item = 7").first().attempts == 2


def test_a_batch_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    store = BK.Store(spark, str(tmp_path / "s"), BK.STATUS)
    one, two = (spark.createDataFrame([(k, START, k, 0, "failed", "x")], EVENTS) for k in (1, 2))
    BK.refresh(store, one, 0)
    before = rows_of(store.read("items"))
    with monkeypatch.context() as m:
        m.setattr(BK.uuid, "uuid4", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.commit({"items": store.read("items")}, 1, "")
    assert rows_of(store.read("items")) == before and not store.done(1, "")
    BK.refresh(store, two, 1)
    assert store.read("items").count() == 2


def parts(spark, rows, schema, top, key):
    for k, edge in enumerate([0, 1, 2, 3]):
        spark.createDataFrame([x for x in rows if key(x) == edge], schema).coalesce(1).write.parquet(f"{top}/part={k}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{top}/*")


def test_refreshing_stream_equals_batch(spark, tmp_path):
    rows = log(80, 5)
    src = parts(spark, rows, EVENTS, tmp_path / "in", lambda x: x[0] % 4)
    for _ in range(2):  # the second start has nothing new
        BK.refresh_to(src, str(tmp_path / "s"), str(tmp_path / "cp")).awaitTermination()
        assert rows_of(BK.progress(BK.Store(spark, str(tmp_path / "s"), BK.STATUS))) == rows_of(rollup(spark.createDataFrame(rows, EVENTS)))


def run(df, tmp_path):
    got = []
    q = df.writeStream.foreachBatch(lambda d, _: got.extend(d.collect())).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp"))
    q.start().awaitTermination()
    return got


def test_stuck_stages(spark, tmp_path, rocks):
    r = random.Random(6)
    at = [START + dt.timedelta(minutes=3 * i) for i in range(160)]
    rows = [(i, at[i], r.randrange(9), r.choice(["pending", "downloading", "completed", "failed"])) for i in range(158)]
    rows += [(158, at[158] + dt.timedelta(days=2), 77, "completed"), (159, at[159] + dt.timedelta(days=3), 77, "completed")]
    schema = "event_id long, ts timestamp, item long, status string"
    src = parts(spark, rows, schema, tmp_path / "in", lambda x: min(x[0] // 50, 3))
    got = run(TM.stuck_stream(src, bound_seconds=1800, late="0 seconds"), tmp_path)
    want = TM.stuck(spark.createDataFrame(rows, schema), bound_seconds=1800).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 5


def test_batches_of_exactly_n(spark, tmp_path, rocks):
    rows = [(i % 3, START + dt.timedelta(seconds=i), i, f"p{i}") for i in range(100)] + [(9, START + dt.timedelta(days=1 + k), 1000 + k, None) for k in range(2)]
    schema = "shard long, ts timestamp, record_id long, payload string"
    src = parts(spark, rows, schema, tmp_path / "in", lambda x: min(x[2] // 30, 3))
    got = sorted(tuple(x) for x in run(TM.batch_stream(src, size=7, wait_seconds=3600, late="0 seconds"), tmp_path))
    want = []
    for shard in range(3):
        own = [x for x in rows if x[0] == shard]
        want += [(shard, i // 7, i % 7, x[2], x[3]) for i, x in enumerate(own)]
    # shard 9: the first record waits an hour alone, the second one has not waited yet
    assert got == sorted([*want, (9, 0, 0, 1000, None)])


def test_a_state_with_a_time_to_live(spark, tmp_path, rocks):
    rows = [(i, START + dt.timedelta(minutes=i), i % 3, "downloading") for i in range(8)]
    schema = "event_id long, ts timestamp, item long, status string"
    got = []
    src = parts(spark, rows, schema, tmp_path / "in", lambda x: x[0] // 2)
    df = S.latest_stream(src, ttl_seconds=3600)
    # with processing time a stream goes on until it is stopped
    q = df.writeStream.foreachBatch(lambda d, _: got.extend(d.collect())).outputMode("update").trigger(processingTime="1 second").option("checkpointLocation", str(tmp_path / "cp")).start()
    for _ in range(60):
        if q.awaitTermination(1) or sum(x["ts"] == rows[-1][1] for x in got):
            break
    q.stop()
    last = {x["item"]: x["attempts"] for x in sorted(got, key=lambda x: x["ts"])}
    assert last == {0: 3, 1: 3, 2: 2}


def test_force(spark):
    items, seen = spark.range(5).withColumnRenamed("id", "item"), spark.createDataFrame([(1,), (3,), (3,), (None,)], "item long")
    assert sorted(x.item for x in ST.todo(items, seen, "item").collect()) == [0, 2, 4]
    assert ST.todo(items, seen, "item", force=True).count() == 5
