import datetime as dt

from pyspark.sql import functions as F

from stenoflow.operators import status as ST
from stenoflow.streaming import status as S

EVENTS = [(i, i % 3, dt.datetime(2024, 1, 1, 0, (7 * i) % 60), ["pending", "downloading", "completed", "failed", "odd"][i % 5], float(i), "e") for i in range(40)]
SCHEMA = "event_id long, item long, ts timestamp, status string, value double, error string"


def stream(spark, tmp_path):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    for k in range(4):
        df.where(F.col("event_id") % 4 == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))


def test_snapshot_equals_batch(spark, tmp_path):
    out = str(tmp_path / "out")
    S.upsert_to(stream(spark, tmp_path), out, str(tmp_path / "cp")).awaitTermination()
    versions = spark.read.parquet(out)
    assert versions.select("version").distinct().count() <= 2
    last = versions.where(F.col("version") == versions.agg(F.max("version")).first()[0])
    batch = ST.latest(spark.createDataFrame(EVENTS, SCHEMA))
    assert {(r["item"], r["status"]) for r in last.collect()} == {(r["item"], r["status"]) for r in batch.collect()}


def test_throughput_stream_equals_batch(spark, tmp_path):
    q = S.throughput(stream(spark, tmp_path), late="2 hours").writeStream.format("memory").queryName("thr").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    batch = S.throughput(spark.createDataFrame(EVENTS, SCHEMA))
    assert {tuple(r) for r in spark.table("thr").collect()} == {tuple(r) for r in batch.collect()}


def test_once(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    assert S.once(df, ["item"]).count() == 3


def test_stateful_latest_equals_batch(spark, tmp_path):
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    try:
        q = S.latest_stream(stream(spark, tmp_path)).writeStream.format("memory").queryName("latest").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {}
    for r in spark.table("latest").orderBy("ts", "attempts").collect():
        got[r["item"]] = (r["status"], r["attempts"])
    batch = ST.latest(spark.createDataFrame(EVENTS, SCHEMA))
    assert got == {r["item"]: (r["status"], r["attempts"]) for r in batch.collect()}
