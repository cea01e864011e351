"""Manifest assembly over the order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stenoflow.functions import links
from stenoflow.operators import manifest as M
from stenoflow.plans.registry import query

WIDE_COLS = """o_orderkey AS ord,
 CASE WHEN o_orderstatus <> 'P' THEN 'v' || CAST(o_orderkey AS {s}) ELSE '' END AS video_id,
 CASE WHEN o_orderstatus = 'F' THEN 't' || CAST(o_custkey AS {s})
      WHEN o_orderstatus = 'P' THEN ' t' || CAST(o_custkey AS {s}) || ' ' END AS transcript_id,
 CASE WHEN o_totalprice > 100000 THEN 'https://video.example/' || CAST(o_orderkey AS {s}) || '.mp4' END AS mp4_video_link,
 CASE WHEN o_orderpriority LIKE '1%' THEN 'https://doc.example/' || CAST(o_custkey AS {s}) || '.pdf' END AS pdf_link,
 CASE WHEN o_orderpriority LIKE '2%' THEN '  ' ELSE 'https://doc.example/' || CAST(o_custkey AS {s}) || '.html' END AS html_link,
 CASE WHEN o_orderstatus = 'F' THEN 'https://sub.example/' || CAST(o_orderkey AS {s}) || '.srt' END AS srt_link"""
WIDE_SQL = f"w AS (SELECT {WIDE_COLS.format(s='VARCHAR')} FROM orders)"


def wide(table) -> DataFrame:
    """A wide manifest with ids that are missing, blank or equal, and four link columns."""
    t = table("orders")
    t.createOrReplaceTempView("_orders_for_manifest")
    return t.sparkSession.sql(f"SELECT {WIDE_COLS.format(s='STRING')} FROM _orders_for_manifest")


@query(
    "candidate_expand",
    f"""WITH {WIDE_SQL}, i AS (SELECT nullif(trim(video_id), '') AS v, nullif(trim(transcript_id), '') AS t FROM w)
SELECT coalesce(v, t) AS video_id, 0 AS ord, coalesce(t, v) AS candidate FROM i
UNION ALL SELECT coalesce(v, t), 1, coalesce(v, t) || '_' || t FROM i WHERE t IS NOT NULL""",
)
def candidate_expand(table):
    return M.candidates(wide(table))


@query(
    "composite_key",
    """SELECT o_custkey AS c_custkey, CAST(o_custkey AS VARCHAR) || '_' || strftime(o_orderdate, '%d%m%Y') || '_' || o_orderstatus AS id,
count(*) AS n FROM orders GROUP BY ALL""",
)
def composite_key(table):
    key = F.concat_ws("_", F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "ddMMyyyy"), "o_orderstatus")
    return table("orders").groupBy(F.col("o_custkey").alias("c_custkey"), key.alias("id")).agg(F.count("*").alias("n"))


@query(
    "shard_assign",
    """WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rank, count(*) OVER () AS n FROM customer)
SELECT c_custkey, rank, CAST(CASE WHEN n < 9 THEN 8 ELSE least((rank - 1) // (n // 9), 8) END AS INTEGER) AS shard FROM r""",
)
def shard_assign(table):
    return M.shards(table("customer").select("c_custkey"), ["c_custkey"], 9)


@query(
    "manifest_unpivot",
    f"""WITH {WIDE_SQL}, i AS (SELECT *, nullif(trim(video_id), '') AS v, nullif(trim(transcript_id), '') AS t FROM w),
s AS (SELECT *, CASE WHEN v IS NOT NULL AND t IS NOT NULL AND v <> t THEN v || '_' || t
      ELSE coalesce(v, t, CAST(ord AS VARCHAR)) END AS session_id FROM i),
u AS (SELECT session_id, v, 'mp4_video_link' AS link_type, mp4_video_link AS url, 'audio' AS modality FROM s
UNION ALL SELECT session_id, v, 'pdf_link', pdf_link, 'transcript' FROM s
UNION ALL SELECT session_id, v, 'html_link', html_link, 'transcript' FROM s
UNION ALL SELECT session_id, v, 'srt_link', srt_link, 'subtitle' FROM s)
SELECT session_id, link_type, trim(url) AS url, modality,
 CASE WHEN modality = 'audio' THEN coalesce(v, session_id) ELSE session_id END AS file_id
FROM u WHERE nullif(trim(url), '') IS NOT NULL""",
)
def manifest_unpivot(table):
    """Work items: a row per link, with session and file ids."""
    w = wide(table).withColumn("session_id", M.session_id(F.col("video_id"), F.col("transcript_id"), F.col("ord")))
    w = w.withColumn("video_id", links.blank_to_null(F.col("video_id")))
    items = M.long_form(w, ["session_id", "video_id"])
    file_id = F.when(F.col("modality") == "audio", F.coalesce("video_id", "session_id")).otherwise(F.col("session_id"))
    return items.select("session_id", "link_type", "url", "modality", file_id.alias("file_id"))


@query(
    "manifest_standardise",
    f"""WITH {WIDE_SQL}
SELECT 'x_' || CAST(ord AS VARCHAR) AS transcript_id, nullif(trim(video_id), '') AS video_id, mp4_video_link AS video_link,
 CASE WHEN regexp_extract(coalesce(pdf_link, html_link), '\\.([A-Za-z0-9]+)$', 1) = 'pdf' THEN pdf_link END AS pdf_link,
 CASE WHEN regexp_extract(coalesce(pdf_link, html_link), '\\.([A-Za-z0-9]+)$', 1) = 'html' THEN html_link END AS html_link
FROM w WHERE mp4_video_link IS NOT NULL AND trim(html_link) <> '' AND NOT ends_with(mp4_video_link, '7.mp4')
 AND contains(lower(mp4_video_link), 'video')""",
)
def manifest_standardise(table):
    """Standard columns, required links, a route by file extension, and negative and keyword predicates."""
    w = wide(table).na.drop("any", subset=["mp4_video_link"]).where(F.trim("html_link") != "")
    w = w.where(~F.col("mp4_video_link").endswith("7.mp4") & F.lower("mp4_video_link").contains("video"))
    ext = links.extension(F.coalesce("pdf_link", "html_link"))
    return w.select(
        F.concat_ws("_", F.lit("x"), F.col("ord").cast("string")).alias("transcript_id"),
        links.blank_to_null(F.col("video_id")).alias("video_id"), F.col("mp4_video_link").alias("video_link"),
        F.when(ext == "pdf", F.col("pdf_link")).alias("pdf_link"), F.when(ext == "html", F.col("html_link")).alias("html_link"),
    )


@query(
    "coalesce_links",
    """WITH w AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'f' || o_custkey END AS a,
 CASE WHEN o_orderstatus = 'O' THEN 'o' || o_custkey END AS b FROM orders)
SELECT o_orderkey, coalesce(a, b) AS link FROM w""",
)
def coalesce_links(table):
    """One column of two that are never both set; a row with both ends the query."""
    tag = lambda s, p: F.when(F.col("o_orderstatus") == s, F.concat(F.lit(p), F.col("o_custkey").cast("string")))
    w = table("orders").select("o_orderkey", tag("F", "f").alias("a"), tag("O", "o").alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    checked = F.when(both, F.raise_error(F.lit("both links are set"))).otherwise(F.coalesce("a", "b"))
    return w.select("o_orderkey", checked.alias("link"))


T_SQL = "t AS (SELECT 'T_' || o_orderstatus || '_' || o_orderkey || '_' || strftime(o_orderdate, '%d%m%Y') AS transcript_id, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS house, o_orderkey AS ord FROM orders)"
V_SQL = "v AS (SELECT 'V_' || l_linestatus || '_' || l_orderkey || '_' || l_linenumber || '_' || strftime(l_shipdate, '%d%m%Y') AS video_id, CAST(l_shipdate AS DATE) AS date, l_linestatus AS house, l_orderkey AS ord FROM lineitem)"


def transcripts(table) -> DataFrame:
    """Transcript links: an order each, with a dated id."""
    id_ = F.concat_ws("_", F.lit("T"), "o_orderstatus", F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "ddMMyyyy"))
    return table("orders").select(id_.alias("transcript_id"), F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("house"), F.col("o_orderkey").alias("ord"))


def videos(table) -> DataFrame:
    """Video links: every line of an order is a recording, with a dated id."""
    id_ = F.concat_ws("_", F.lit("V"), "l_linestatus", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.date_format("l_shipdate", "ddMMyyyy"))
    return table("lineitem").select(id_.alias("video_id"), F.to_date("l_shipdate").alias("date"), F.col("l_linestatus").alias("house"), F.col("l_orderkey").alias("ord"))


@query(
    "merge_on_date",
    f"""WITH {T_SQL}, {V_SQL}
SELECT split_part(transcript_id, '_', -1) AS join_key, count(*) AS pairs, min(transcript_id || '_' || video_id) AS first_id,
 max(transcript_id || '_' || video_id) AS last_id
FROM t JOIN v ON split_part(transcript_id, '_', -1) = split_part(video_id, '_', -1) GROUP BY 1""",
)
def merge_on_date(table):
    """n x m join on the date in the ids, summed up by date: each side by itself, so no pairs are made."""
    key = links.last_part
    return M.merge_counts(transcripts(table), videos(table), key, key).select("join_key", "pairs", "first_id", "last_id")


def _by_date(table) -> DataFrame:
    key = links.last_part
    return M.merge_on_key(transcripts(table).select("transcript_id"), videos(table).select("video_id"), key, key)


@query(
    "merge_on_date_rows",
    f"""WITH {T_SQL}, {V_SQL}
SELECT split_part(transcript_id, '_', -1) AS join_key, transcript_id, video_id, transcript_id || '_' || video_id AS merged_id
FROM t JOIN v ON split_part(transcript_id, '_', -1) = split_part(video_id, '_', -1)""",
)
def merge_on_date_rows(table):
    """Every merged pair of a date."""
    return _by_date(table).select("join_key", "transcript_id", "video_id", "merged_id")


@query(
    "merge_on_composite",
    f"""WITH {T_SQL}, {V_SQL},
tk AS (SELECT transcript_id, split_part(transcript_id, '_', -1) || CASE WHEN house = 'O' THEN '_Commons' ELSE '_Westminster' END AS k FROM t),
vk AS (SELECT video_id, split_part(video_id, '_', -1) || CASE WHEN house = 'O' THEN '_Commons' ELSE '_Westminster' END AS k FROM v)
SELECT k AS join_key, count(*) AS pairs, count(DISTINCT transcript_id) AS transcripts, count(DISTINCT video_id) AS videos
FROM tk JOIN vk USING (k) GROUP BY 1""",
)
def merge_on_composite(table):
    """Join on date and house, summed up by key."""
    return M.merge_counts(transcripts(table), videos(table), _date_and_house, _date_and_house).select("join_key", "pairs", "transcripts", "videos")


def _date_and_house(c: Column) -> Column:
    return F.concat(links.last_part(c), F.when(F.split_part(c, F.lit("_"), F.lit(2)) == "O", "_Commons").otherwise("_Westminster"))


@query(
    "merge_on_composite_rows",
    f"""WITH {T_SQL}, {V_SQL},
tk AS (SELECT transcript_id, split_part(transcript_id, '_', -1) || CASE WHEN house = 'O' THEN '_Commons' ELSE '_Westminster' END AS k FROM t),
vk AS (SELECT video_id, split_part(video_id, '_', -1) || CASE WHEN house = 'O' THEN '_Commons' ELSE '_Westminster' END AS k FROM v)
SELECT k AS join_key, transcript_id, video_id FROM tk JOIN vk USING (k)""",
)
def merge_on_composite_rows(table):
    """Every pair of the same date and house."""
    t, v = transcripts(table).select("transcript_id"), videos(table).select("video_id")
    return M.merge_on_key(t, v, _date_and_house, _date_and_house).select("join_key", "transcript_id", "video_id")


@query(
    "safe_date_join",
    """WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders),
b AS (SELECT l_orderkey, strftime(l_shipdate, '%d/%m/%Y') AS raw FROM lineitem),
x AS (SELECT o_orderkey, TRY_CAST(raw AS DATE) AS d FROM a), y AS (SELECT l_orderkey, CAST(try_strptime(raw, '%d/%m/%Y') AS DATE) AS d FROM b),
xc AS (SELECT d, count(*) AS n FROM x WHERE d IS NOT NULL GROUP BY d), yc AS (SELECT d, count(*) AS m FROM y WHERE d IS NOT NULL GROUP BY d)
SELECT (SELECT count(*) FROM x WHERE d IS NULL) AS invalid_left, (SELECT count(*) FROM y WHERE d IS NULL) AS invalid_right,
 (SELECT CAST(sum(n * m) AS BIGINT) FROM xc JOIN yc USING (d)) AS matched, (SELECT count(*) FROM xc JOIN yc USING (d)) AS dates,
 (SELECT CAST(sum(n) AS BIGINT) FROM xc JOIN yc USING (d)) AS left_rows""",
)
def safe_date_join(table):
    """Match statistics of a join on safely parsed dates, from counts per date on both sides."""
    from stenoflow.functions.dates import parse

    raw_t = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    x = table("orders").select(parse(raw_t, ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("d"))
    raw_v = F.date_format("l_shipdate", "dd/MM/yyyy")
    y = table("lineitem").select(parse(raw_v, ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("d"))
    xc, yc = x.groupBy("d").agg(F.count("*").alias("n")), y.groupBy("d").agg(F.count("*").alias("m"))
    j = xc.alias("x").join(yc.alias("y"), F.col("x.d").eqNullSafe(F.col("y.d")), "full_outer")
    known = F.col("x.d").isNotNull() & F.col("y.d").isNotNull()
    null = lambda c, n: F.coalesce(F.sum(F.when(F.col(f"{c}.d").isNull(), F.col(n))), F.lit(0))
    return j.agg(
        null("x", "n").alias("invalid_left"), null("y", "m").alias("invalid_right"),
        F.sum(F.when(known, F.col("n") * F.col("m"))).alias("matched"), F.count_if(known).alias("dates"),
        F.sum(F.when(known, F.col("n"))).alias("left_rows"),
    )


@query(
    "unmatched_keys",
    f"""WITH {T_SQL}, {V_SQL}
SELECT date, CASE WHEN date IN (SELECT date FROM t) THEN 'transcript' ELSE 'video' END AS side
FROM (SELECT DISTINCT date FROM t UNION SELECT DISTINCT date FROM v)
WHERE (date IN (SELECT date FROM t)) <> (date IN (SELECT date FROM v))""",
)
def unmatched_keys(table):
    return M.unmatched(transcripts(table), videos(table), "date")


CASCADE_SQL = f"""{T_SQL}, {V_SQL},
e AS (SELECT DISTINCT t.transcript_id, v.video_id FROM t JOIN v USING (ord) WHERE t.house = 'F'),
rest AS (SELECT * FROM t WHERE transcript_id NOT IN (SELECT transcript_id FROM e)),
c AS (SELECT *, count(*) OVER (PARTITION BY date) AS n FROM v),
m AS (SELECT transcript_id, video_id, 'explicit' AS match_type FROM e
UNION ALL SELECT r.transcript_id, c.video_id, CASE WHEN n = 1 THEN 'unique_date' ELSE 'multi_date' END FROM rest r JOIN c USING (date)
UNION ALL SELECT r.transcript_id, v.video_id, 'next_day' FROM rest r JOIN v ON v.date = r.date + 1
 WHERE r.date >= DATE '1997-01-01' AND r.date NOT IN (SELECT date FROM v))"""


def _sides(table) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transcripts, videos, and explicit links between them."""
    t, v = transcripts(table), videos(table)
    return t, v, t.where("house = 'F'").select("transcript_id", "ord").join(v.select("video_id", "ord"), "ord").select("transcript_id", "video_id")


@query("cascade_match", f"WITH {CASCADE_SQL} SELECT transcript_id, match_type, count(*) AS videos, min(video_id) AS first_video FROM m GROUP BY ALL")
def cascade_match(table):
    """Number of matches of every transcript, with the rule that gave them."""
    return M.cascade_counts(*_sides(table), cutoff="1997-01-01")


@query("cascade_rows", f"WITH {CASCADE_SQL} SELECT transcript_id, video_id, match_type FROM m")
def cascade_rows(table):
    """Every match with the rule that gave it."""
    return M.cascade(*_sides(table), cutoff="1997-01-01").select("transcript_id", "video_id", "match_type")


@query(
    "cascade_stats",
    f"""WITH {CASCADE_SQL}
SELECT match_type, count(DISTINCT transcript_id) AS transcripts, count(*) AS matches,
 round(100.0 * count(DISTINCT transcript_id) / (SELECT count(*) FROM t), 4) AS percent FROM m GROUP BY match_type""",
)
def cascade_stats(table):
    n = transcripts(table).agg(F.count("*").alias("n"))
    per = M.cascade_counts(*_sides(table), cutoff="1997-01-01").groupBy("match_type").agg(F.count("*").alias("transcripts"), F.sum("videos").alias("matches"))
    return per.join(F.broadcast(n)).select("match_type", "transcripts", "matches", F.round(100.0 * F.col("transcripts") / F.col("n"), 4).alias("percent"))


@query(
    "strict_one_to_one",
    """WITH a AS (SELECT o_custkey AS k, min(o_orderkey) AS a_id FROM orders GROUP BY 1 HAVING count(*) = 1),
b AS (SELECT l_suppkey AS k, l_partkey AS p, min(l_orderkey) AS b_id FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1),
oa AS (SELECT CAST(o_orderdate AS DATE) AS d, o_custkey AS c, min(o_orderkey) AS o FROM orders GROUP BY 1, 2 HAVING count(*) = 1),
ob AS (SELECT CAST(l_shipdate AS DATE) AS d, l_partkey AS c, min(l_orderkey) AS l FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1)
SELECT d, c, o, l FROM oa JOIN ob USING (d, c)""",
)
def strict_one_to_one(table):
    """Sessions that are unique on both sides, matched on date and number."""
    left = table("orders").select(F.to_date("o_orderdate").alias("d"), F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("o"))
    right = table("lineitem").select(F.to_date("l_shipdate").alias("d"), F.col("l_partkey").alias("c"), F.col("l_orderkey").alias("l"))
    return M.strict_one_to_one(left, right, ["d", "c"])


@query(
    "two_key_anti",
    """SELECT c_custkey, c_nationkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
 AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.c_custkey)""",
)
def two_key_anti(table):
    """Customers in neither of two known sets."""
    c = table("customer").select("c_custkey", "c_nationkey")
    first = M.anti(c, table("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])
    return M.anti(first, table("supplier").select(F.col("s_suppkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey", "c_nationkey")


@query(
    "contains_anti",
    r"""WITH k AS (SELECT DISTINCT 'p' || p_partkey AS token FROM part WHERE p_size <= 10),
u AS (SELECT l_orderkey, l_linenumber, 'https://media.example/p' || l_partkey || '/' || l_linenumber AS url FROM lineitem)
SELECT l_orderkey, l_linenumber, url FROM u WHERE regexp_extract(url, '/(p[0-9]+)/', 1) NOT IN (SELECT token FROM k)""",
)
def contains_anti(table):
    """Links that hold no known token; the token has a shape, so it is cut out and joined by equality."""
    known = table("part").where("p_size <= 10").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("token"))
    url = F.concat(F.lit("https://media.example/p"), F.col("l_partkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    u = table("lineitem").select("l_orderkey", "l_linenumber", url.alias("url"))
    u = u.withColumn("token", F.regexp_extract("url", r"/(p[0-9]+)/", 1))
    return M.anti(u, known, ["token"]).select("l_orderkey", "l_linenumber", "url")


@query(
    "incremental_todo",
    """WITH done AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
present AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'F'),
tries AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT o_orderkey, coalesce(n, 0) AS attempts FROM orders LEFT JOIN tries ON l_orderkey = o_orderkey
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM done) AND o_orderkey IN (SELECT l_orderkey FROM present) AND coalesce(n, 0) < 3""",
)
def incremental_todo(table):
    """Ids that are not processed, have their recording, and failed less than three times."""
    l = table("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")  # noqa: E741
    todo = M.anti(table("orders").select("o_orderkey"), l.where("l_returnflag = 'R'"), ["o_orderkey"])
    todo = todo.join(l.where("l_linestatus = 'F'").select("o_orderkey").distinct(), "o_orderkey", "left_semi")
    tries = l.where("l_returnflag = 'A'").groupBy("o_orderkey").agg(F.count("*").alias("n"))
    attempts = F.coalesce("n", F.lit(0))
    return todo.join(tries, "o_orderkey", "left").select("o_orderkey", attempts.alias("attempts")).where("attempts < 3")


@query(
    "asset_resolve",
    """WITH a AS (SELECT l_orderkey AS id, l_returnflag AS ext, l_linenumber AS pri, l_suppkey || '/' || l_orderkey || '.' || l_returnflag AS path FROM lineitem)
SELECT id, ext, arg_max(path, (pri, path)) AS transcript_path, min(first_path) AS audio_path
FROM a JOIN (SELECT id, arg_min(path, (pri, path)) AS first_path FROM a GROUP BY id) USING (id) GROUP BY id, ext""",
)
def asset_resolve(table):
    """Files of an id: for audio the first directory, for transcripts the last one of each extension."""
    path = F.concat(F.col("l_suppkey").cast("string"), F.lit("/"), F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_returnflag"))
    a = table("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("ext"), F.col("l_linenumber").alias("pri"), path.alias("path"))
    per = a.groupBy("id", "ext").agg(
        F.max_by("path", F.struct("pri", "path")).alias("transcript_path"), F.min(F.struct("pri", "path")).alias("f")
    )
    first = F.min("f").over(Window.partitionBy("id"))["path"]
    return per.select("id", "ext", "transcript_path", first.alias("audio_path"))


@query(
    "documents_pivot",
    """SELECT o_custkey, coalesce(min(CASE WHEN o_orderstatus = 'F' THEN o_orderkey::VARCHAR END), '') AS F,
 coalesce(min(CASE WHEN o_orderstatus = 'O' THEN o_orderkey::VARCHAR END), '') AS O,
 coalesce(min(CASE WHEN o_orderstatus = 'P' THEN o_orderkey::VARCHAR END), '') AS P FROM orders GROUP BY 1""",
)
def documents_pivot(table):
    """A column per document type with its first link, empty where there is none."""
    o = table("orders").select("o_custkey", "o_orderstatus", F.col("o_orderkey").cast("string").alias("link"))
    return o.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.min("link")).na.fill("")


ZIP_SQL = """l AS (SELECT o_custkey, string_agg('v' || o_orderkey, ';' ORDER BY o_orderkey) AS videos,
 string_agg('m' || o_orderkey || '_514.mp4?x', ';' ORDER BY o_orderkey) FILTER (o_orderstatus = 'F') AS mp4s FROM orders GROUP BY 1)"""


@query(
    "zip_explode",
    f"""WITH {ZIP_SQL}, s AS (SELECT o_custkey, string_split(videos, ';') AS v, string_split(mp4s, ';') AS m FROM l),
x AS (SELECT o_custkey, unnest(range(1, greatest(len(v), coalesce(len(m), 0)) + 1)) AS i, v, m FROM s)
SELECT o_custkey, CAST(i AS INTEGER) AS part, coalesce(v[i], '') AS video, coalesce(regexp_extract(m[i], '^.*514\\.mp4'), '') AS mp4 FROM x""",
)
def zip_explode(table):
    """Positional pairs of two lists of links, the shorter one padded; renditions are cut after .mp4."""
    o = table("orders")
    ordered = lambda c, when: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(when, F.struct("o_orderkey", c.alias("x"))))), lambda s: s["x"]), ";")
    key = F.col("o_orderkey").cast("string")
    lists = o.groupBy("o_custkey").agg(
        ordered(F.concat(F.lit("v"), key), F.lit(True)).alias("videos"),
        ordered(F.concat(F.lit("m"), key, F.lit("_514.mp4?x")), F.col("o_orderstatus") == "F").alias("mp4s"),
    )
    split = lambda c: F.filter(F.split(c, ";"), lambda x: x != "")
    zipped = lists.select("o_custkey", F.posexplode_outer(F.arrays_zip(split("videos").alias("v"), split("mp4s").alias("m"))).alias("p", "z"))
    return zipped.select(
        "o_custkey", (F.coalesce("p", F.lit(0)) + 1).cast("int").alias("part"), F.coalesce("z.v", F.lit("")).alias("video"),
        F.coalesce(F.regexp_extract("z.m", r"^.*514\.mp4", 0), F.lit("")).alias("mp4"),
    )


@query(
    "lookup_left",
    """WITH v AS (SELECT l_suppkey AS id, arg_max(l_partkey, (l_shipdate, l_orderkey, l_linenumber)) AS video FROM lineitem GROUP BY 1)
SELECT c_custkey, video, count(video) OVER () AS matched FROM customer LEFT JOIN v ON id = c_custkey""",
)
def lookup_left(table):
    """Left lookup in which the last of repeated keys wins, with the number of matches."""
    l = table("lineitem").select(F.col("l_suppkey").alias("c_custkey"), F.col("l_partkey").alias("video"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("o"))  # noqa: E741
    joined = table("customer").select("c_custkey").join(M.last_wins(l, ["c_custkey"], "o", "video"), "c_custkey", "left")
    return joined.join(F.broadcast(joined.agg(F.count("video").alias("matched"))))


@query(
    "freq_count",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
)
def freq_count(table):
    return table("events").groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "count_histogram",
    "SELECT n AS videos, count(*) AS dates FROM (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1",
)
def count_histogram(table):
    """How many dates have how many recordings."""
    per = table("lineitem").groupBy(F.to_date("l_shipdate")).agg(F.count("*").alias("videos"))
    return per.groupBy("videos").agg(F.count("*").alias("dates"))


@query(
    "pair_patterns",
    """WITH g AS (SELECT o_custkey, array_agg(o_orderpriority ORDER BY o_orderkey) AS p, array_agg(o_orderstatus ORDER BY o_orderkey) AS s
 FROM orders GROUP BY 1 HAVING count(*) = 2),
c AS (SELECT CASE WHEN p[1] LIKE '1%' AND p[2] LIKE '2%' THEN 'part1_part2' WHEN s[1] = 'F' AND s[2] = 'O' THEN 'morning_evening' ELSE 'other' END AS pattern,
 CAST(p[1] <> p[2] AS INTEGER) + CAST(s[1] <> s[2] AS INTEGER) AS methods FROM g)
SELECT pattern, count(*) AS pairs, count(*) FILTER (methods > 1) AS several, count(*) FILTER (methods = 0) AS failed,
 round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM c GROUP BY 1""",
)
def pair_patterns(table):
    """Two-row groups by the pattern of their titles, and how many attributes tell the rows apart."""
    row = F.struct("o_orderkey", "o_orderpriority", "o_orderstatus")
    g = table("orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.min(row).alias("a"), F.max(row).alias("b")).where("n = 2")
    pattern = (
        F.when(F.col("a.o_orderpriority").like("1%") & F.col("b.o_orderpriority").like("2%"), "part1_part2")
        .when((F.col("a.o_orderstatus") == "F") & (F.col("b.o_orderstatus") == "O"), "morning_evening").otherwise("other")
    )
    methods = (F.col("a.o_orderpriority") != F.col("b.o_orderpriority")).cast("int") + (F.col("a.o_orderstatus") != F.col("b.o_orderstatus")).cast("int")
    per = g.select(pattern.alias("pattern"), methods.alias("m")).groupBy("pattern").agg(
        F.count("*").alias("pairs"), F.count_if(F.col("m") > 1).alias("several"), F.count_if(F.col("m") == 0).alias("failed")
    )
    return per.withColumn("percent", F.round(100.0 * F.col("pairs") / F.sum("pairs").over(Window.partitionBy()), 4))


@query(
    "duplicate_ids",
    """WITH k AS (SELECT o_orderkey, o_custkey || '_' || strftime(o_orderdate, '%Y%m') AS id FROM orders),
c AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY o_orderkey) AS r FROM k)
SELECT id, o_orderkey, n, r > 1 AS later FROM c WHERE n > 1""",
)
def duplicate_ids(table):
    """All members of groups with an id that is not unique; the second and later ones are flagged."""
    id_ = F.concat_ws("_", F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyyMM"))
    w = Window.partitionBy("id")
    return (
        table("orders").select("o_orderkey", id_.alias("id")).withColumn("n", F.count("*").over(w))
        .withColumn("later", F.row_number().over(w.orderBy("o_orderkey")) > 1).where("n > 1").select("id", "o_orderkey", "n", "later")
    )


@query(
    "first_occurrence",
    """SELECT user_id, event_type, min(event_id) AS event_id FROM events
WHERE NOT contains(lower(event_type), 'english') AND NOT contains(lower(coalesce(props, '')), 'lang=en') GROUP BY 1, 2""",
)
def first_occurrence(table):
    """First row of every key, without those of another language."""
    other = F.lower("event_type").contains("english") | F.lower(F.coalesce("props", F.lit(""))).contains("lang=en")
    return M.first_wins(table("events").where(~other), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query(
    "unique_session_id",
    """SELECT o_orderkey, strftime(o_orderdate, '%d%m%Y') || '_' || o_orderstatus ||
 CASE WHEN count(*) OVER w > 1 THEN '_' || row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE), o_orderstatus ORDER BY o_orderkey) ELSE '' END AS session_id
FROM orders WINDOW w AS (PARTITION BY CAST(o_orderdate AS DATE), o_orderstatus)""",
)
def unique_session_id(table):
    """Date and type, with a number within them where they are not unique."""
    w = Window.partitionBy(F.to_date("o_orderdate"), "o_orderstatus")
    number = F.when(F.count("*").over(w) > 1, F.row_number().over(w.orderBy("o_orderkey")).cast("string"))
    return table("orders").select("o_orderkey", F.concat_ws("_", F.date_format("o_orderdate", "ddMMyyyy"), "o_orderstatus", number).alias("session_id"))


@query(
    "hash_sample",
    "SELECT doc_id, source FROM documents WHERE substr(md5(CAST(doc_id AS VARCHAR)), 1, 2) < '20'",
)
def hash_sample(table):
    """A repeatable sample of an eighth of the documents."""
    return table("documents").where(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 2) < "20").select("doc_id", "source")


@query(
    "stratified_sample",
    """SELECT source, doc_id FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) <= 2""",
)
def stratified_sample(table):
    """At most two documents of every source."""
    h = F.md5(F.col("doc_id").cast("string").cast("binary"))
    w = Window.partitionBy("source").orderBy("h", "doc_id")
    return table("documents").select("source", "doc_id", h.alias("h")).withColumn("r", F.row_number().over(w)).where("r <= 2").select("source", "doc_id")
