import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stenoflow.functions import dates, links, text
from stenoflow.operators import manifest, speech, status, timeline


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_text_functions(spark):
    one = lambda x, c: values(spark, [(x,)], "x string", c(F.col("x")))[0]
    assert one("  a \n b\t", text.collapse) == "a b"
    assert one("", text.tokens) == [] and one(" a  b ", text.tokens) == ["a", "b"]
    assert one("<p>a<b>b</b></p>", text.strip_tags) == "abb"[:2]
    assert one("PSBiH i BiH.", lambda c: text.expand_abbreviations(c, {"BiH": "Bosna", "PSBiH": "P$"})) == "P$ i Bosna."
    assert one("<script>x<y</script>a&nbsp;<!-- c -->&amp;lt;", text.html_to_text) == "a &lt;"
    assert one("<P class=a>x <b>y</b></p><p></p><p>z</p>", text.html_paragraphs) == "x y\nz"
    assert one("Hello, [noise] World (x)!", text.normalise_for_wer) == "hello world"


def test_word_distance(spark):
    rows = [(["a", "b", "c"], ["a", "x", "c", "d"]), ([], ["a"]), (["a"], ["a"])]
    assert values(spark, rows, "a array<string>, b array<string>", text.word_distance(F.col("a"), F.col("b"))) == [2, 1, 0]


def test_dates(spark):
    one = lambda x, c: values(spark, [(x,)], "x string", c(F.col("x")))[0]
    forms = ["yyyy-MM-dd", "dd/MM/yyyy", "d. M. yyyy"]
    for x in ("2020-03-04", "04/03/2020", "4. 3. 2020"):
        assert one(x, lambda c: dates.parse(c, forms)) == dt.date(2020, 3, 4)
    assert one("soon", lambda c: dates.parse(c, forms)) is None
    assert one("4. mars 2020", lambda c: dates.spelled(c, "norwegian")) == dt.date(2020, 3, 4)
    assert one("4 foo 2020", dates.spelled) is None
    assert one("01:02:03,500", dates.srt_seconds) == 3723.5
    assert one("02:05", dates.minute_clock) == 125 and one("1:2:3", dates.minute_clock) is None
    assert values(spark, [(13.29,), (13.07,)], "x double", dates.decimal_clock(F.col("x"))) == ["13:29", "13:07"]


def test_links(spark):
    one = lambda x, c: values(spark, [(x,)], "x string", c(F.col("x")))[0]
    assert one("/a/b.mp4", lambda c: links.absolute(c, "https://h/")) == "https://h/a/b.mp4"
    assert one("https://h/a", lambda c: links.absolute(c, "https://x")) == "https://h/a"
    assert one("http://www.H.no/a?b=1#c", links.bare) == "h.no/a" and one("https://m.h.no/a", links.bare) == "h.no/a"
    assert one("N. Name (PS)", links.party_of) == "PS" and one("Partido", links.party_of) == "Partido"


def test_candidates_and_long_form(spark):
    rows = [("v1", "t1", "u"), ("", "t2", " "), ("v3", None, None)]
    df = spark.createDataFrame(rows, "video_id string, transcript_id string, pdf_link string")
    got = {(r["video_id"], r["ord"], r["candidate"]) for r in manifest.candidates(df).collect()}
    assert got == {("v1", 0, "t1"), ("v1", 1, "v1_t1"), ("t2", 0, "t2"), ("t2", 1, "t2_t2"), ("v3", 0, "v3")}
    assert [r["url"] for r in manifest.long_form(df, ["video_id"]).collect()] == ["u"]
    with pytest.raises(PySparkException):
        manifest.candidates(spark.createDataFrame([("", " ", "x")], df.schema)).collect()


def test_session_id(spark):
    rows = [("v", "t", 0), ("v", "v", 1), (None, "t", 2), ("", None, 3)]
    got = values(spark, rows, "v string, t string, o int", manifest.session_id(F.col("v"), F.col("t"), F.col("o")))
    assert got == ["v_t", "v", "t", "3"]


def test_shards(spark):
    for n, tasks in ((10, 3), (2, 5), (9, 3)):
        got = manifest.shards(spark.range(n).toDF("id"), ["id"], tasks).orderBy("id").collect()
        size = n // tasks
        assert [r["shard"] for r in got] == [tasks - 1 if not size else min(i // size, tasks - 1) for i in range(n)]
        assert [r["rank"] for r in got] == list(range(1, n + 1))


def test_cascade(spark):
    d = dt.date
    t = spark.createDataFrame([("a", d(2020, 1, 1)), ("b", d(2020, 1, 2)), ("c", d(2020, 1, 3)), ("e", d(2020, 1, 5))], "transcript_id string, date date")
    v = spark.createDataFrame([("x", d(2020, 1, 2)), ("y", d(2020, 1, 3)), ("z", d(2020, 1, 3)), ("w", d(2020, 1, 6))], "video_id string, date date")
    e = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "unknown")], "transcript_id string, video_id string")
    got = {tuple(r) for r in manifest.cascade(t, v, e, cutoff="2020-01-04").collect()}
    assert got == {("a", "x", "explicit"), ("b", "x", "unique_date"), ("c", "y", "multi_date"), ("c", "z", "multi_date"), ("e", "w", "next_day")}


def test_gaps_and_segments_cover_the_recording(spark):
    sp = spark.createDataFrame([("v", 2.0, 5.0), ("v", 4.0, 9.0), ("w", 0.0, 30.0)], "video string, start double, end double")
    ext = spark.createDataFrame([("v", 12.0), ("w", 30.0), ("none", 50.0)], "video string, duration double")
    got = {tuple(r) for r in timeline.gaps(sp, ext).collect()}
    assert got == {("v", 0.0, 2.0), ("v", 9.0, 12.0)}
    sil = spark.createDataFrame([("v", 12.0, 14.0), ("v", 17.0, 18.0), ("w", 0.0, 11.0)], "video string, start double, end double")
    ext = spark.createDataFrame([("v", 45.0), ("w", 25.0)], "video string, duration double")
    seg = [(r["video"], r["start"], r["end"]) for r in timeline.greedy_segments(sil, ext).orderBy("video", "seg_idx").collect()]
    assert seg == [("v", 0.0, 13.0), ("v", 13.0, 33.0), ("v", 33.0, 45.0), ("w", 11.0, 25.0)]


def test_crop_counts_an_intersection_once(spark):
    s = spark.createDataFrame([("v", 500.0, 1900.0)], "video string, start double, end double")
    w = spark.createDataFrame([("v", 0, 0.0, 2000.0), ("v", 1, 1900.0, 2000.0)], "video string, w int, w_start double, w_end double")
    assert [tuple(r) for r in timeline.crop(s, w).collect()] == [("v", 0, 500.0, 1900.0)]


def test_turns(spark):
    rows = [("s", 0, False, "x", "early"), ("s", 1, True, "A", "h"), ("s", 2, False, None, "p"), ("s", 3, True, "B", "")]
    df = spark.createDataFrame(rows, "s string, pos int, head boolean, who string, t string")
    got = speech.turns(df, "s", "pos", F.col("head"), F.col("who"), F.col("t")).orderBy("turn").collect()
    assert [(r["speaker"], r["speech"]) for r in got] == [("A", "h\np"), ("B", "")]


def test_status(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [(1, "i", t(3), "completed", None), (2, "i", t(1), "failed", "late"), (3, "i", t(0), "odd", None), (4, "i", t(2), "downloading", None)]
    ev = spark.createDataFrame(rows, "event_id long, item string, ts timestamp, status string, error string")
    r = status.latest(ev).collect()[0]
    assert (r["status"], r["attempts"], r["last_error"]) == ("completed", 1, "late")


def test_a_repeated_key_ends_the_query(spark):
    from stenoflow.operators import manifest as M

    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, x string")
    assert M.unique_or_raise(df.where("x <> 'c'"), ["id"]).count() == 2 and M.unique_or_raise(df.where("false"), ["id"]).count() == 0
    with pytest.raises(Exception, match="repeated key: 2"):
        M.unique_or_raise(df, ["id"]).collect()


def test_transitions_of_states(spark):
    from stenoflow.operators import status as ST

    rows = [(1, 1, "pending"), (1, 2, "downloading"), (1, 3, "failed"), (1, 4, "downloading"), (1, 5, "completed"), (1, 6, "pending"), (2, 1, "completed")]
    df = spark.createDataFrame(rows, "item int, event_id int, status string").withColumn("ts", F.timestamp_seconds("event_id"))
    got = ST.transitions(df, ST.DOWNLOAD).orderBy("item", "event_id").collect()
    assert [r["legal"] for r in got] == [True, True, True, True, True, False, False]
    assert [r["seconds"] for r in got] == [1, 1, 1, 1, 1, None, None]
    items = spark.createDataFrame([(1,), (3,)], "item int")
    assert [r[0] for r in ST.todo(items, df, "item").collect()] == [3] and ST.todo(items, df, "item", force=True).count() == 2


def test_speeches_without_speaker_or_text_stay(spark):
    from stenoflow.operators import speech as S

    df = spark.createDataFrame([("a", 1, "X", "one"), ("a", 2, None, "two"), ("a", 3, "Y", None)], "g string, o int, s string, t string")
    text = S.formatted(df, "g", "o", F.col("s"), F.col("t")).collect()[0]["text"]
    assert text.count("[SPEECH]") == 3 and "two" in text


def test_counts_equal_the_pairs(spark):
    t = spark.createDataFrame([("t1_a", dt.date(2000, 1, 1)), ("t2_a", dt.date(2000, 1, 1)), ("t3_b", dt.date(2000, 1, 2)), ("t4_c", dt.date(2000, 1, 9)), ("t5_x", None)], "transcript_id string, date date")
    v = spark.createDataFrame([("v1_a", dt.date(2000, 1, 1)), ("v2_a", dt.date(2000, 1, 1)), ("v3_b", dt.date(2000, 1, 2)), ("v4_d", dt.date(2000, 1, 10)), ("v4_d", dt.date(2000, 1, 10)), ("v5_x", None)], "video_id string, date date")
    explicit = spark.createDataFrame([("t2_a", "v1_a"), ("t2_a", "v1_a"), ("t2_a", "none")], "transcript_id string, video_id string")
    rows = manifest.cascade(t, v, explicit, cutoff="1999-01-01").groupBy("transcript_id", "match_type").agg(F.count("*").alias("videos"), F.min("video_id").alias("first_video"))
    counts = manifest.cascade_counts(t, v, explicit, cutoff="1999-01-01")
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, rows.collect())) and counts.count() == 4
    key = lambda c: F.split_part(c, F.lit("_"), F.lit(2))
    pairs = manifest.merge_on_key(t, v, key, key).groupBy("join_key").agg(
        F.count("*").alias("pairs"), F.count_distinct("transcript_id").alias("transcripts"), F.count_distinct("video_id").alias("videos"),
        F.min("merged_id").alias("first_id"), F.max("merged_id").alias("last_id"))
    assert sorted(map(tuple, manifest.merge_counts(t, v, key, key).collect())) == sorted(map(tuple, pairs.collect()))
