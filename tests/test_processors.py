import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.functions import processors as P
from stenoflow.operators import timeline
from stenoflow.streaming import segments


def test_processors_by_parliament(spark):
    p = P.Processors()
    p.register("a", F.upper)
    p.register_python("b", lambda x: x[::-1] if x != "bad" else 1 / 0)
    df = spark.createDataFrame([("a", "<p>x"), ("b", "xy"), ("b", "bad"), ("b", None), ("c", "<p>x y</p>")], "k string, h string")
    assert [r[0] for r in df.select(p.apply(F.col("k"), F.col("h"))).collect()] == ["<P>X", "yx", None, None, "x y"]


def test_preprocess_and_links(spark):
    srt = "1\n00:00:01,000 --> 00:00:02,000\n<i>a</i>\n\n2\n00:00:03,000 --> 00:00:04,000\nb"
    df = spark.createDataFrame([("txt", " a  b "), ("srt", srt), ("HTML", "<p>BiH</p>"), ("pdf", "x")], "e string, c string")
    assert [r[0] for r in df.select(P.preprocess(F.col("e"), F.col("c"), {"BiH": "Bosna"})).collect()] == ["a b", "a b", "Bosna", None]
    links = spark.createDataFrame([("https://h/a.m3u8?x",), ("https://youtu.be/1",), ("https://h/a.mp4",), ("https://h/",), ("no",)], "u string")
    assert [r[0] and r[0]["kind"] for r in links.select(P.video_link(F.col("u"))).collect()] == ["m3u8", "youtube", "file", "page", None]


def test_contracts(spark):
    df = spark.createDataFrame([("ok",), ("odd",), (None,)], "status string")
    good, bad = P.quarantine(df, "status", ["ok"])
    assert good.count() == 1 and bad.count() == 2
    schema = T.StructType().add("n", T.LongType(), False).add("cer", T.DoubleType())
    assert P.check_metrics({"n": 1, "cer": 0.5}, schema) == []
    assert P.check_metrics({"cer": "x", "z": 1}, schema) == ["unknown: z", "missing: n", "type: cer"]
    with pytest.raises(ValueError):
        P.require_processors(df, {"status": "p"}, set())


def test_streamed_segments_equal_batch(spark, tmp_path):
    rows = [("v", float(s), float(s + d)) for s, d in [(3, 2), (14, 1), (16, 3), (31, 12), (60, 2), (71, 4), (90, 1)]]
    parts = [rows[:2], rows[2:5], [*rows[5:], ("v", None, 97.0)]]
    schema = "video string, start double, end double"
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={k}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        got = []
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        q = segments.greedy_stream(src).writeStream.foreachBatch(lambda d, _: got.extend(d.collect())).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    batch = timeline.greedy_segments(spark.createDataFrame(rows, schema), spark.createDataFrame([("v", 97.0)], "video string, duration double"))
    key = lambda r: (r["seg_idx"], r["start"], r["end"])
    assert sorted(map(key, got)) == sorted(map(key, batch.collect()))
