"""Contracts, orders and sets over manifests, and the alignment state machine."""

from __future__ import annotations

from pyspark.sql import functions as F

from stenoflow.functions import links
from stenoflow.functions.dates import parse
from stenoflow.operators import manifest as M
from stenoflow.operators import status as ST
from stenoflow.operators import timeline as TL
from stenoflow.plans.manifest import T_SQL, V_SQL, transcripts, videos
from stenoflow.plans.registry import query
from stenoflow.plans.timeline import IV_SQL, intervals


@query("unique_contract", "SELECT o_orderkey, o_custkey FROM orders")
def unique_contract(table):
    """Orders, if no id is repeated; otherwise the query ends."""
    return M.unique_or_raise(table("orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@query("not_null_id_first", """SELECT o_orderkey, o_custkey, year(o_orderdate) AS year, o_clerk AS clerk FROM
 (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_clerk FROM orders) WHERE o_clerk IS NOT NULL AND year(o_orderdate) >= 1995""")
def not_null_id_first(table):
    """Rows with a value, from a year on, with ids first."""
    clerk = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    day = parse(F.date_format("o_orderdate", "dd/MM/yyyy"), ["dd/MM/yyyy"])
    o = table("orders").select(F.year(day).alias("year"), clerk.alias("clerk"), "o_custkey", "o_orderkey")
    return M.id_first(o.where(F.col("clerk").isNotNull() & (F.col("year") >= 1995)), "o_orderkey", "o_custkey")


@query("ordered_page", """SELECT o_orderkey, d FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
ORDER BY d DESC NULLS LAST, o_orderkey LIMIT 25 OFFSET 10""")
def ordered_page(table):
    """The third ten and a half by date, latest first, rows without a date at the end."""
    raw = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    o = table("orders").select("o_orderkey", parse(raw, ["yyyy-MM-dd"]).alias("d"))
    return M.page_of(o, 10, 25, F.col("d").desc_nulls_last(), F.col("o_orderkey"))


@query("first_and_last", """SELECT user_id, arg_min(event_id, (CAST(ts AS DATE), coalesce(t, ''), event_id)) AS first_event, arg_max(event_id, (CAST(ts AS DATE), coalesce(t, ''), event_id)) AS last_event
FROM (SELECT *, CASE WHEN event_type <> 'error' THEN strftime(ts, '%H:%M') END AS t FROM events) GROUP BY 1""")
def first_and_last(table):
    """First and last event of every user by date and time, an unknown time before all others."""
    time = F.coalesce(F.when(F.col("event_type") != "error", F.date_format("ts", "HH:mm")), F.lit(""))
    at = F.struct(F.to_date("ts").alias("d"), time.alias("t"), F.col("event_id").alias("e"))
    return table("events").groupBy("user_id").agg(F.min_by("event_id", at).alias("first_event"), F.max_by("event_id", at).alias("last_event"))


@query("unmatched_examples", f"""WITH {T_SQL}, {V_SQL}, u AS (SELECT date, 'transcript' AS side FROM (SELECT DISTINCT date FROM t) WHERE date NOT IN (SELECT date FROM v)
UNION ALL SELECT date, 'video' FROM (SELECT DISTINCT date FROM v) WHERE date NOT IN (SELECT date FROM t))
SELECT side, date, count(*) OVER (PARTITION BY side) AS n FROM u QUALIFY row_number() OVER (PARTITION BY side ORDER BY date) <= 5""")
def unmatched_examples(table):
    """Dates that only one side has: the first five of either side, and how many there are."""
    return M.both_unmatched(transcripts(table), videos(table), "date", 5)


@query("shared_dates", f"WITH {T_SQL}, {V_SQL} SELECT date FROM t INTERSECT SELECT date FROM v")
def shared_dates(table):
    """Dates on both sides."""
    return transcripts(table).select("date").intersect(videos(table).select("date"))


@query("lookup_inner", """WITH v AS (SELECT l_suppkey AS id, arg_max(l_partkey, (l_shipdate, l_orderkey, l_linenumber)) AS video FROM lineitem GROUP BY 1)
SELECT c_custkey, video FROM customer JOIN v ON id = c_custkey""")
def lookup_inner(table):
    """Inner lookup in which the last of repeated keys wins."""
    o = F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("o")
    v = table("lineitem").select(F.col("l_suppkey").alias("c_custkey"), F.col("l_partkey").alias("video"), o)
    return M.lookup_inner(table("customer").select("c_custkey"), v, "c_custkey", "o", "video")


@query("filename_dates", """WITH f AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderstatus = 'F' THEN '-' || (o_orderkey % 3 + 1) ELSE '' END || '.htm' AS file FROM orders),
k AS (SELECT o_orderkey, file, CAST(strptime(left(file, 8), '%Y%m%d') AS DATE) AS date, TRY_CAST(regexp_extract(file, '-([0-9]+)', 1) AS INTEGER) AS number FROM f),
n AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS videos FROM lineitem GROUP BY 1)
SELECT o_orderkey, file, date, number, coalesce(videos, 0) AS videos FROM k LEFT JOIN n USING (date)""")
def filename_dates(table):
    """Transcript files named by date and number, with the recordings of that date."""
    number = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("-"), (F.col("o_orderkey") % 3 + 1).cast("string"))).otherwise("")
    files = table("orders").select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyyMMdd"), number, F.lit(".htm")).alias("file"))
    keyed = files.select("*", links.file_date(F.col("file")).alias("date"), links.file_number(F.col("file")).alias("number"))
    n = table("lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count("*").alias("videos"))
    return keyed.join(n, "date", "left").select("o_orderkey", "file", "date", "number", F.coalesce("videos", F.lit(0)).alias("videos"))


@query("position_lookup", """WITH u AS (SELECT l_orderkey, l_linenumber, 'https://video.example/play?id=' || l_orderkey || '&pos=' || l_linenumber AS url FROM lineitem),
s AS (SELECT o_orderkey, o_orderkey % 5 + 1 AS pos, o_custkey AS start FROM orders)
SELECT l_orderkey, l_linenumber, start FROM u LEFT JOIN s ON o_orderkey = l_orderkey AND pos = CAST(regexp_extract(url, '[?&]pos=([0-9]+)', 1) AS BIGINT)""")
def position_lookup(table):
    """Times of speeches by the position in their link."""
    url = F.concat(F.lit("https://video.example/play?id="), F.col("l_orderkey").cast("string"), F.lit("&pos="), F.col("l_linenumber").cast("string"))
    pos = F.try_parse_url(url, F.lit("QUERY"), F.lit("pos")).cast("long")
    u = table("lineitem").select("l_orderkey", "l_linenumber", pos.alias("pos"))
    s = table("orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 5 + 1).alias("pos"), F.col("o_custkey").alias("start"))
    return u.join(s, ["l_orderkey", "pos"], "left").select("l_orderkey", "l_linenumber", "start")


SP_SQL = f"""{IV_SQL.replace("SCALE", "60")}, sp AS (SELECT *, CAST(floor(start) AS BIGINT) % 3 AS label FROM iv)"""


@query("speaker_overlap", f"""WITH {SP_SQL} SELECT a.video, round(a.start, 6) AS start, round(a."end", 6) AS "end", a.label, round(max(b."end"), 6) AS until
FROM (SELECT DISTINCT * FROM sp) a JOIN sp b ON a.video = b.video AND b.start <= a.start AND b."end" > a.start AND a.label <> b.label GROUP BY a.video, a.start, a."end", a.label""")
def speaker_overlap(table):
    """Speech that begins while another speaker goes on."""
    sp = intervals(table, 60.0).withColumn("label", F.floor("start") % 3)
    got = TL.overlaps(sp, "video", "label")
    return got.select("video", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "label", F.round("until", 6).alias("until"))


STEPS = {"signup": "initializing", "view": "segmenting", "click": "transcribing", "purchase": "completed", "error": "failed"}
AL_SQL = """ev AS (SELECT event_id, ts, user_id AS item, CASE WHEN event_type = 'signup' THEN 'initializing' WHEN event_type = 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'segmenting' ELSE 'segmenting_complete' END
 WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'transcribing' ELSE 'transcribing_complete' END WHEN event_type = 'purchase' THEN 'completed' ELSE 'failed' END AS status FROM events),
tr AS (SELECT *, lag(status) OVER w AS before, epoch_us(lead(ts) OVER w) // 1000000 - epoch_us(ts) // 1000000 AS seconds FROM ev WINDOW w AS (PARTITION BY item ORDER BY ts, event_id)),
ok AS (SELECT * FROM (VALUES (NULL, 'initializing'), ('initializing', 'segmenting'), ('initializing', 'failed'), ('segmenting', 'segmenting_complete'), ('segmenting', 'failed'),
 ('segmenting_complete', 'transcribing'), ('segmenting_complete', 'failed'), ('transcribing', 'transcribing_complete'), ('transcribing', 'failed'),
 ('transcribing_complete', 'completed'), ('transcribing_complete', 'failed'), ('failed', 'initializing'), ('completed', 'initializing')) AS x(a, b))"""


@query("alignment_states", f"""WITH {AL_SQL} SELECT item, status, count(*) AS times, count(*) FILTER (NOT EXISTS (SELECT 1 FROM ok WHERE a IS NOT DISTINCT FROM before AND b = status)) AS illegal,
 CAST(coalesce(sum(seconds), 0) AS BIGINT) AS seconds FROM tr GROUP BY 1, 2""")
def alignment_states(table):
    """Visits, illegal steps and time of every state of every alignment."""
    half = lambda s: F.when(F.col("event_id") % 2 == 0, s).otherwise(f"{s}_complete")
    status = F.coalesce(*[F.when(F.col("event_type") == k, half(v) if v in ("segmenting", "transcribing") else F.lit(v)) for k, v in STEPS.items()], F.lit("failed"))
    ev = table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("item"), status.alias("status"))
    return ST.stage_durations(ev, ST.ALIGNMENT)
