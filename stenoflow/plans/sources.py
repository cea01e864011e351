"""Subtitles, session and batch documents and logs, written from the tables and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from stenoflow.plans.registry import query
from stenoflow.sources import readers as R
from stenoflow.sources import writers as W


def _stamp(s):
    ms = F.round(s * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms % 3600000 / 60000), F.floor(ms % 60000 / 1000), ms % 1000)


def subtitles(table):
    """A subtitle text for each user: a cue per event, tags in the text."""
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000 % 86400
    start = F.round(start, 3)
    cue = F.concat(F.col("event_id").cast("string"), F.lit("\n"), _stamp(start), F.lit(" --> "), _stamp(start + F.round("value", 2)), F.lit("\n<i>"), F.col("event_type"), F.lit("</i>  said\r\nso"))
    cues = table("events").select("user_id", "event_id", cue.alias("c"))
    listed = F.sort_array(F.collect_list(F.struct("event_id", "c")))
    return cues.groupBy("user_id").agg(F.array_join(F.transform(listed, lambda x: x["c"]), "\n\n").alias("content"))


SRT_SQL = """c AS (SELECT user_id, event_id AS cue, round(epoch_us(ts) / 1000000.0 % 86400, 3) AS s, round(value, 2) AS v, event_type FROM events)"""


@query("srt_cues", f"""WITH {SRT_SQL} SELECT user_id, CAST(cue AS INTEGER) AS cue, CAST(round(s * 1000) AS BIGINT) AS start_ms, CAST(round((s + v) * 1000) AS BIGINT) AS end_ms, event_type || ' said so' AS text FROM c""")
def srt_cues(table):
    """Cues of the subtitle texts."""
    got = R.srt_cues(subtitles(table), F.col("content"), "user_id")
    return got.select("user_id", "cue", F.round(F.col("start") * 1000).cast("long").alias("start_ms"), F.round(F.col("end") * 1000).cast("long").alias("end_ms"), "text")


@query("srt_last_ts", f"""WITH {SRT_SQL} SELECT user_id, round(arg_max(s + v, cue), 2) AS last_end FROM c GROUP BY 1""")
def srt_last_ts(table):
    return subtitles(table).select("user_id", F.round(R.srt_last_end(F.col("content")), 2).alias("last_end"))


@query("session_json_flatten", """SELECT CAST(conv_id AS VARCHAR) AS session, CAST(conv_id % 7 + 0.5 AS DOUBLE) AS section, 'conversation ' || conv_id AS title,
 CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS pos,
 CASE WHEN turn % 2 = 0 THEN lpad(CAST(turn % 24 AS VARCHAR), 2, '0') || ':30' ELSE '13:' || lpad(CAST(turn % 60 AS VARCHAR), 2, '0') END AS time, role AS type, role AS speaker,
 CASE WHEN role = 'assistant' THEN 'a' ELSE '' END AS party, md5(text) AS text FROM conversations QUALIFY role <> 'system'""")
def session_json_flatten(table):
    """Speeches out of nested session documents; statements without a name are dropped."""
    c = F.col
    speech = F.struct(
        F.when(c("turn") % 2 == 0, F.format_string("2024-05-01T%02d:30:00", c("turn") % 24)).alias("time"), (13 + c("turn") % 60 / 100).alias("clock"), c("role").alias("type"),
        F.struct(F.when(c("role") != "system", c("role")).alias("name"), F.when(c("role") == "assistant", "a").alias("party")).alias("speaker"),
        F.array("text").alias("content"))
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text", speech.alias("s"))))
    docs = table("conversations").groupBy("conv_id").agg(rows.alias("r")).select(
        F.to_json(F.struct(c("conv_id").cast("string").alias("session"), F.array(F.struct((c("conv_id") % 7 + 0.5).cast("double").alias("number"), F.concat(F.lit("conversation "), c("conv_id").cast("string")).alias("title"),
                  F.transform("r", lambda x: x["s"]).alias("speeches"))).alias("sections"))).alias("document"))
    return R.session_speeches(docs, c("document")).withColumn("text", F.md5(c("text").cast("binary")))


@query("batch_doc_roundtrip", """SELECT 'd' || doc_id AS transcript_id, doc_id % 3 = 0 AS was_bytes, md5(text) AS content, 'https://x.example/' || doc_id AS url FROM documents""")
def batch_doc_roundtrip(table):
    """Documents through batch files of fifty, a third of them as encoded bytes."""
    is_bytes = F.col("doc_id") % 3 == 0
    rows = table("documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("transcript_id"), F.col("doc_id").alias("ord"), F.when(~is_bytes, F.col("text")).alias("content"),
        F.when(is_bytes, F.encode("text", "utf-8")).alias("raw"), F.concat(F.lit("https://x.example/"), F.col("doc_id").cast("string")).alias("url"))
    back = R.batch_documents(W.batch_documents(rows, 50), F.col("document"))
    whole = F.coalesce("content", F.decode("raw", "utf-8"))
    return back.select("transcript_id", F.col("raw").isNotNull().alias("was_bytes"), F.md5(whole.cast("binary")).alias("content"), "url")


@query("log_failures", """WITH f AS (SELECT DISTINCT 'https://x.example/' || user_id AS url FROM events WHERE event_type = 'error'
 UNION SELECT DISTINCT 'https://y.example/' || user_id FROM events WHERE event_type = 'signup' AND value > 20)
SELECT event_id, 'https://x.example/' || user_id AS url FROM events WHERE 'https://x.example/' || user_id IN (SELECT url FROM f)""")
def log_failures(table):
    """Rows whose link failed, by a log with two forms of message."""
    user = F.col("user_id").cast("string")
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("12:00 ERROR Failed to process https://x.example/"), user, F.lit(" after 2 tries")))
        .when((F.col("event_type") == "signup") & (F.col("value") > 20), F.concat(F.lit("12:01 Error for url: https://y.example/"), user)).otherwise("12:02 INFO done"))
    failed = R.failed_urls(table("events").select(line.alias("line")), F.col("line"))
    rows = table("events").select("event_id", F.concat(F.lit("https://x.example/"), user).alias("url"))
    return rows.join(failed, "url", "left_semi").select("event_id", "url")
