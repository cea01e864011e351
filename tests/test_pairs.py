"""All pairs of a key, dealt to tasks."""

from pyspark.sql import functions as F

from stenoflow.operators import alignment
from stenoflow.operators import manifest as M


def test_pairs_of_a_hot_key_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 16)
    monkeypatch.setattr(M, "TASK_PAIRS", 1_000)
    day = lambda i: f"{'hot' if i % 4 else i % 40}"
    t = [(f"t{i}", None if i == 3 else day(i)) for i in range(300)] + [("t1", "hot"), ("t1", "hot"), ("only", "left")]
    v = [(f"v{i}", None if i == 5 else day(i)) for i in range(200)] + [("v2", "hot"), ("no", "right")]
    got = M.all_pairs(spark.createDataFrame(t, "t string, k string"), spark.createDataFrame(v, "v string, k string").coalesce(1), "k", "t", "v")
    want = sorted((k, a, b) for a, k in t for b, x in v if k == x and k is not None)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(map(tuple, got.select("k", "t", "v").collect())) == want
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) < len(want) / 4
    assert M.all_pairs(got.select("k", "t").limit(0), got.select("k", "v"), "k", "t", "v").count() == 0


def test_what_a_rule_leaves_is_found_once(spark):
    day = lambda i: f"1997-01-{i:02d}"
    t = spark.createDataFrame([("a", day(1)), ("b", day(2)), ("c", day(3)), ("d", day(5)), ("e", day(9)), ("f", None)], "transcript_id string, d string")
    v = spark.createDataFrame([("v", day(2)), ("w", day(3)), ("x", day(3)), ("y", day(6))], "video_id string, d string")
    t, v = (x.withColumn("date", F.to_date("d")) for x in (t, v))
    explicit = spark.createDataFrame([("a", "w"), ("a", "w"), ("b", "none")], "transcript_id string, video_id string")
    got = M.cascade(t, v, explicit, cutoff="1997-01-01")
    want = [("a", "w", "explicit"), ("b", "v", "unique_date"), ("c", "w", "multi_date"), ("c", "x", "multi_date"), ("d", "y", "next_day")]
    assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "LeftSemi" not in plan


def test_only_texts_near_a_segment_are_read_for_pairs(spark):
    segs = spark.createDataFrame([(1, "a b c d e f".split()), (2, ["x"])], "seg int, stoks array<string>").withColumn("asr", F.array_join("stoks", " "))
    texts = [(k, f"z{k} y w v u t".split()) for k in range(50)] + [(60, "q a b c d r".split()), (61, "f e d c b a".split()), (62, None), (63, ["a"])]
    docs = spark.createDataFrame(texts, "doc int, toks array<string>")
    assert [(r.doc, r.toks) for r in alignment.nearby(segs, docs).collect()] == [(60, "q a b c d r".split())]
    paired = alignment.pairs(segs, docs)
    assert [(r.seg, r.doc, r.lo, r.hi, r.n) for r in paired.collect()] == [(1, 60, 1, 1, 6)]
    plan = paired._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and paired.rdd.getNumPartitions() == alignment.parts(paired)
