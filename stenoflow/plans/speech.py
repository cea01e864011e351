"""Speeches (conversations), texts (documents) and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from stenoflow.functions import links
from stenoflow.functions import text as X
from stenoflow.operators import manifest as M
from stenoflow.operators import speech as S
from stenoflow.plans.registry import ORACLE_SQL, query

# The oracle reads white space, tags and entities with the same patterns as the functions.
WS = r"[ \t\n\x0b\f\r]+"


@query("carry_forward", """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN left(text, 20) END IGNORE NULLS) OVER
 (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS header FROM conversations""")
def carry_forward(table):
    """Every turn with the head of the last user turn."""
    header = F.when(F.col("role") == "user", F.substring("text", 1, 20))
    return S.carry_forward(table("conversations"), "conv_id", "turn", header, "header").select("conv_id", "turn", "header")


@query("turn_grouping", """WITH n AS (SELECT *, sum(CAST(role = 'user' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS t FROM conversations)
SELECT conv_id, CAST(t AS BIGINT) AS turn, arg_min(role, turn) AS speaker, md5(string_agg(text, chr(10) ORDER BY turn, text)) AS speech FROM n WHERE t > 0 GROUP BY conv_id, t""")
def turn_grouping(table):
    """A speech per user turn with what follows it."""
    c = table("conversations").withColumnRenamed("turn", "pos")
    got = S.turns(c, "conv_id", "pos", F.col("role") == "user", F.col("role"), F.col("text"))
    return got.withColumn("speech", F.md5(F.col("speech").cast("binary")))


@query("speech_format", """SELECT conv_id, md5(string_agg('[SPEECH] ' || turn || chr(10) || 'Speaker: ' || role || chr(10) || 'Content:' || chr(10) || text,
 chr(10) || repeat('=', 80) || chr(10) ORDER BY turn, role, text)) AS text FROM conversations GROUP BY 1""")
def speech_format(table):
    got = S.formatted(table("conversations"), "conv_id", "turn", F.col("role"), F.col("text"))
    return got.withColumn("text", F.md5(F.col("text").cast("binary")))


@query("content_blocks", """SELECT conv_id, md5(string_agg(nullif(trim(text), ''), chr(10) || chr(10) ORDER BY turn, role, text)) AS content FROM conversations GROUP BY 1""")
def content_blocks(table):
    """Contents cut out of the marked texts again."""
    got = S.formatted(table("conversations"), "conv_id", "turn", F.col("role"), F.col("text"))
    return got.select("conv_id", F.md5(S.content_blocks(F.col("text")).cast("binary")).alias("content"))


@query("speech_stats", """SELECT conv_id, count(*) AS total, count(*) FILTER (role = 'user') AS users, count(*) FILTER (role = 'assistant') AS answers,
 count(*) FILTER (role = 'system') AS systems FROM conversations GROUP BY 1""")
def speech_stats(table):
    n = lambda r: F.count_if(F.col("role") == r)
    return table("conversations").groupBy("conv_id").agg(
        F.count("*").alias("total"), n("user").alias("users"), n("assistant").alias("answers"), n("system").alias("systems")
    )


@query("speaker_list", """SELECT conv_id, string_agg(role, ',' ORDER BY first_at, role) AS speakers FROM
(SELECT conv_id, role, min(turn) AS first_at FROM conversations WHERE role <> 'system' GROUP BY 1, 2) GROUP BY 1""")
def speaker_list(table):
    """Speakers by first appearance, without the chair."""
    return S.speakers_in_order(table("conversations"), "conv_id", "turn", F.when(F.col("role") != "system", F.col("role")))


@query("speaker_count_check", """WITH t AS (SELECT conv_id, string_agg('**' || role || '** ' || text, chr(10)) AS m, count(DISTINCT role) AS expected FROM conversations GROUP BY 1)
SELECT conv_id, CAST((length(m) - length(replace(m, '**', ''))) // 2 // 2 AS BIGINT) AS found, expected FROM t
WHERE (length(m) - length(replace(m, '**', ''))) // 2 // 2 <> expected""")
def speaker_count_check(table):
    """Sessions whose marked speakers are not as many as expected."""
    marked = F.concat(F.lit("**"), "role", F.lit("** "), "text")
    t = table("conversations").groupBy("conv_id").agg(
        F.sum(F.regexp_count(marked, F.lit(r"\*\*"))).alias("marks"), F.count_distinct("role").alias("expected")
    )
    return t.select("conv_id", F.floor(F.col("marks") / 2).cast("long").alias("found"), "expected").where("found <> expected")


@query("session_split", """SELECT conv_id, 'session' AS kind, count(*) AS n, min(turn) AS first_turn, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY 1
UNION ALL SELECT conv_id, 'intervention', 1, turn, length(text) FROM conversations""")
def session_split(table):
    """Nested sessions, split into a table of sessions and one of interventions."""
    nested = table("conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("speeches"))
    chars = F.aggregate("speeches", F.lit(0).cast("long"), lambda s, x: s + F.char_length(x["text"]))
    parents = nested.select("conv_id", F.lit("session").alias("kind"), F.size("speeches").cast("long").alias("n"),
                            F.element_at("speeches", 1)["turn"].alias("first_turn"), chars.alias("chars"))
    children = nested.select("conv_id", F.explode("speeches").alias("s")).select(
        "conv_id", F.lit("intervention").alias("kind"), F.lit(1).cast("long").alias("n"), F.col("s.turn").alias("first_turn"),
        F.char_length("s.text").cast("long").alias("chars"))
    return parents.unionByName(children)


@query("speaker_change", """SELECT conv_id, turn, previous, role FROM
(SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations) WHERE previous <> role""")
def speaker_change(table):
    from stenoflow.operators.timeline import label_changes

    return label_changes(table("conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "previous", "role")


@query("clean_text", rf"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '<[^>]+>', '', 'g'), '{WS}', ' ', 'g'))) AS clean,
 length(regexp_replace(text, '\n{WS.replace('+', '*')}\n', E'\n\n', 'g')) AS chars FROM documents""")
def clean_text(table):
    """Tags stripped, white space collapsed; blank lines collapsed."""
    t = F.col("text")
    return table("documents").select(
        "doc_id", F.md5(X.collapse(X.strip_tags(t)).cast("binary")).alias("clean"),
        F.char_length(X.collapse_blank_lines(t)).cast("long").alias("chars"),
    )


ABBREVIATIONS = {"st": "saint", "er": "error", "de": "deutsch", "the": "those"}


@query("abbrev_expand", r"""SELECT doc_id, md5(array_to_string(list_transform(regexp_extract_all(text, '[\p{L}\p{M}\p{N}\p{Pc}]+|[^\p{L}\p{M}\p{N}\p{Pc}]+'),
 lambda x: CASE x WHEN 'st' THEN 'saint' WHEN 'er' THEN 'error' WHEN 'de' THEN 'deutsch' WHEN 'the' THEN 'those' ELSE x END), '')) AS expanded FROM documents""")
def abbrev_expand(table):
    """Whole-word abbreviations in the whole texts, with the word ends of Unicode."""
    t = X.expand_abbreviations(F.col("text"), ABBREVIATIONS)
    return table("documents").select("doc_id", F.md5(t.cast("binary")).alias("expanded"))


query("abbrev_expand_full", ORACLE_SQL["abbrev_expand"])(abbrev_expand)


RULES = [("evening", ["evening", "ening"]), ("morning", ["morning", "orning"]), ("hour", ["hour", "ou"])]


@query("title_attributes", r"""WITH t AS (SELECT doc_id, lower(split_part(text, chr(10), 1)) AS x FROM documents)
SELECT doc_id, CASE WHEN contains(x, 'evening') OR contains(x, 'ening') THEN 'evening' WHEN contains(x, 'morning') OR contains(x, 'orning') THEN 'morning'
 WHEN contains(x, 'hour') OR contains(x, 'ou') THEN 'hour' END AS part_of_day,
 CASE WHEN regexp_matches(x, 'part (\d+)') THEN CAST(regexp_extract(x, 'part (\d+)', 1) AS INTEGER)
      WHEN regexp_matches(x, '(i{1,3})nt') THEN length(regexp_extract(x, '(i{1,3})nt', 1)) END AS part,
 regexp_matches(x, '\d+\s*-\s*\d+') AS several_days FROM t""")
def title_attributes(table):
    """Part of day by keywords, part number by patterns (else the length of a Roman numeral), span of days."""
    x = F.lower(F.split_part("text", F.lit("\n"), F.lit(1)))
    number = F.nullif(F.regexp_extract(x, r"part (\d+)", 1), F.lit("")).try_cast("int")
    roman = F.nullif(F.char_length(F.regexp_extract(x, r"(i{1,3})nt", 1)), F.lit(0))
    return table("documents").select(
        "doc_id", X.by_rules(x, RULES).alias("part_of_day"), F.coalesce(number, roman).alias("part"),
        F.coalesce(x.rlike(r"\d+\s*-\s*\d+"), F.lit(False)).alias("several_days"),
    )


ENT = "x"
for _k, _v in X.ENTITIES.items():
    ENT = f"replace({ENT}, '{_k.replace(chr(39), chr(39) * 2)}', '{_v.replace(chr(39), chr(39) * 2)}')"


@query("html_text", rf"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g') AS x FROM pages)
SELECT page_id, md5(trim(regexp_replace({ENT}, '{WS}', ' ', 'g'))) AS text FROM a""")
def html_text(table):
    return table("pages").select("page_id", F.md5(X.html_to_text(F.col("html")).cast("binary")).alias("text"))


@query("html_paragraphs", rf"""WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p>', 1)) AS raw, generate_subscripts(regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p>', 1), 1) AS i FROM pages),
c AS (SELECT page_id, i, regexp_replace(raw, '<[^>]+>', ' ', 'g') AS x FROM p), d AS (SELECT page_id, i, trim(regexp_replace({ENT}, '{WS}', ' ', 'g')) AS t FROM c)
SELECT page_id, count(*) FILTER (t <> '') AS n, md5(coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (t <> ''), '')) AS text FROM pages LEFT JOIN d USING (page_id) GROUP BY 1""")
def html_paragraphs(table):
    t = X.html_paragraphs(F.col("html"))
    return table("pages").select("page_id", t.alias("t")).select(
        "page_id", F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", "\n"))).cast("long").alias("n"), F.md5(F.col("t").cast("binary")).alias("text"))


@query("page_links", r"""SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages) GROUP BY ALL""")
def page_links(table):
    """Link targets of every page."""
    found = F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))
    return table("pages").select("page_id", found.alias("link")).groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query("page_script_json", r"""SELECT page_id, CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) AS state_id, '/p' || regexp_extract(html, 'track\((\d+)\)', 1) AS stream FROM pages
WHERE regexp_matches(html, 'track\(\d+\)')""")
def page_script_json(table):
    """State of the page's script, read as JSON."""
    state = F.concat(F.lit('{"media":{"id":'), F.regexp_extract("html", r"(?s)<script>.*?track\((\d+)\).*?</script>", 1), F.lit(',"stream":"/p'), F.regexp_extract("html", r"track\((\d+)\)", 1), F.lit('"}}'))
    got = table("pages").where(F.col("html").rlike(r"track\(\d+\)")).select("page_id", state.alias("j"))
    return got.select("page_id", F.get_json_object("j", "$.media.id").cast("long").alias("state_id"), F.get_json_object("j", "$.media.stream").alias("stream"))


@query("html_rows", r"""WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS row, generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) AS i FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS item, regexp_extract(row, 'href="([^"]*)"', 1) AS url, regexp_extract(row, '>([^<]*)</a>', 1) AS label FROM r""")
def html_rows(table):
    """Records of row blocks: position, target and label."""
    rows = F.posexplode(F.regexp_extract_all("html", F.lit("<li>(.*?)</li>"), F.lit(1)))
    r = table("pages").select("page_id", rows.alias("i", "row"))
    return r.select("page_id", (F.col("i") + 1).alias("item"), F.regexp_extract("row", 'href="([^"]*)"', 1).alias("url"), F.regexp_extract("row", ">([^<]*)</a>", 1).alias("label"))


@query("page_blocks", r"""WITH b AS (SELECT page_id, unnest((string_split(html, '<p>'))[2:]) AS block, generate_subscripts((string_split(html, '<p>'))[2:], 1) AS i FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS block, nullif(regexp_extract(block, '<b>([^<]*)', 1), '') AS speaker, length(trim(regexp_replace(block, '<[^>]+>', '', 'g'))) AS chars FROM b""")
def page_blocks(table):
    """Blocks of a page with speaker, if there is one, and length; orphan blocks stay."""
    blocks = F.posexplode(F.slice(F.split("html", "<p>"), 2, 1 << 30))
    b = table("pages").select("page_id", blocks.alias("i", "b"))
    return b.select("page_id", (F.col("i") + 1).alias("block"), F.nullif(F.regexp_extract("b", "<b>([^<]*)", 1), F.lit("")).alias("speaker"),
                    F.char_length(F.trim(X.strip_tags(F.col("b")))).cast("long").alias("chars"))


@query("url_functions", r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
 split_part(split_part(split_part(url, '?', 1), '#', 1), '/', -1) AS last_part, nullif(regexp_extract(url, '/([a-z]{2})/\d+', 1), '') AS lang,
 'https://docs.example/PTK_' || lpad(split_part(split_part(split_part(url, '?', 1), '#', 1), '/', -1), 4, '0') || '.pdf' AS pdf_link,
 CASE WHEN regexp_matches(url, '^https') THEN 'secure' ELSE 'plain' END AS scheme FROM pages""")
def url_functions(table):
    """Parts of links and links derived from them."""
    u = F.col("url")
    last = links.last_part(F.regexp_replace(u, "[?#].*$", ""), "/")
    return table("pages").select(
        "page_id", links.host(u).alias("host"), links.query_parameter(u, "page").alias("page"), last.alias("last_part"),
        links.blank_to_null(F.regexp_extract(u, r"/([a-z]{2})/\d+", 1)).alias("lang"),
        F.concat(F.lit("https://docs.example/PTK_"), F.lpad(last, 4, "0"), F.lit(".pdf")).alias("pdf_link"),
        F.when(u.rlike("^https"), "secure").otherwise("plain").alias("scheme"),
    )


NORM = r"regexp_replace(regexp_replace(lower(url), '^https?://(?:www\.|m\.)?', ''), '[?#].*$', '')"


@query("url_normal_join", f"""WITH a AS (SELECT page_id, {NORM} AS k FROM pages), b AS (SELECT page_id AS other, {NORM} AS k FROM pages WHERE url LIKE 'https%')
SELECT page_id, count(other) AS matches, min(other) AS first_match FROM a LEFT JOIN b ON a.k = b.k AND other <> page_id GROUP BY 1""")
def url_normal_join(table):
    """Pages under one address written in different ways; pages without a match stay."""
    a = table("pages").select("page_id", links.bare(F.col("url")).alias("k"))
    b = table("pages").where("url like 'https%'").select(F.col("page_id").alias("other"), links.bare(F.col("url")).alias("k"))
    hit = F.col("other") != F.col("page_id")
    return a.join(b, "k", "left").groupBy("page_id").agg(F.count_if(hit).alias("matches"), F.min(F.when(hit, F.col("other"))).alias("first_match"))


@query("url_unmatched", f"""WITH a AS (SELECT DISTINCT {NORM} AS k FROM pages WHERE url NOT LIKE 'https%'), b AS (SELECT DISTINCT {NORM} AS k FROM pages WHERE url LIKE 'https%')
SELECT k, 'transcript' AS side FROM a WHERE k NOT IN (SELECT k FROM b WHERE k IS NOT NULL) UNION ALL SELECT k, 'video' FROM b WHERE k NOT IN (SELECT k FROM a WHERE k IS NOT NULL)""")
def url_unmatched(table):
    """Addresses that only one side of the join has: plain ones (transcript) and those of secure pages (video)."""
    pages = table("pages").select(links.bare(F.col("url")).alias("k"), F.col("url").startswith("https").alias("secure"))
    return M.unmatched(pages.where("NOT secure"), pages.where("secure"), "k")
