"""Alignment of perturbed benchmark passages with documents.

All queries see every document, of any language or none, and whole Unicode texts; the names that end
in _full are kept beside the shorter ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoflow.functions import text as X
from stenoflow.operators import align_exact, alignment, proven, selection
from stenoflow.plans.registry import ORACLE_SQL, query

# The oracle's distances count bytes: every character but white space is written as one of a byte, one for one.
BYTES_SQL = r"""ch AS (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)),
cn AS (SELECT c, row_number() OVER (ORDER BY c) + 13 AS n FROM ch WHERE NOT regexp_matches(c, '[ \t\n\x0b\f\r]')),
cm AS (SELECT string_agg(c, '' ORDER BY n) AS f, string_agg(chr(CAST(CASE WHEN n < 32 THEN n ELSE n + 1 END AS INTEGER)), '' ORDER BY n) AS t FROM cn)"""
PAIR_SQL = BYTES_SQL + r""",
d AS (SELECT doc_id AS doc, list_filter(string_split_regex(translate(text, (SELECT f FROM cm), (SELECT t FROM cm)), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS toks FROM documents),
um AS (SELECT translate('um', f, t) AS um FROM cm),
b AS (SELECT item_id AS seg, list_filter(string_split_regex(translate(text, (SELECT f FROM cm), (SELECT t FROM cm)), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS t, um FROM benchmark, um),
s0 AS (SELECT seg, list_filter(list_transform(t, lambda x, i: CASE WHEN i % 7 = 0 THEN NULL WHEN i % 11 = 0 THEN um ELSE x END), lambda x: x IS NOT NULL) AS stoks FROM b),
s AS (SELECT seg, stoks, array_to_string(stoks, ' ') AS asr, len(stoks) AS w FROM s0),
sg AS (SELECT seg, i AS spos, array_to_string(stoks[i + 1 : i + 4], ' ') AS gram FROM s, unnest(range(0, greatest(w - 3, 0))) AS u(i)),
dg AS (SELECT doc, i AS dpos, array_to_string(toks[i + 1 : i + 4], ' ') AS gram FROM d, unnest(range(0, greatest(len(toks) - 3, 0))) AS u(i)),
a AS (SELECT seg, doc, min(dpos - spos) AS lo, max(dpos - spos) AS hi FROM dg JOIN sg USING (gram) GROUP BY 1, 2),
p AS (SELECT a.*, asr, w, toks, len(toks) AS n FROM a JOIN s USING (seg) JOIN d USING (doc))"""
COARSE_SQL = f"""{PAIR_SQL},
r AS (SELECT *, greatest(w // 2, 1) AS step, greatest(n - w, 0) AS last, least(greatest(lo - w, 0), greatest(n - w, 0)) AS first FROM p),
c AS (SELECT seg, doc, asr, w, toks, n, pos, levenshtein(asr, array_to_string(toks[pos + 1 : pos + w], ' ')) / CAST(length(asr) AS DOUBLE) AS cer
 FROM r, unnest(range(first, greatest(least(hi + w, last), first) + 1, step)) AS u(pos)),
co AS (SELECT *, row_number() OVER (PARTITION BY seg, doc ORDER BY cer, pos) AS rank FROM c QUALIFY row_number() OVER (PARTITION BY seg, doc ORDER BY cer, pos) <= 3)"""
FINE_SQL = f"""{COARSE_SQL},
k AS (SELECT seg, doc, asr, rank, st AS start, ln AS length, array_to_string(toks[st + 1 : st + ln], ' ') AS human, CAST(ceil(length(asr) * 0.45) AS INTEGER) AS lim
 FROM co, unnest(range(greatest(pos - 15, 0), least(pos + 15, n - 1) + 1)) AS u(st), unnest(range(greatest(w - 15, 1), w + 16)) AS v(ln) WHERE st + ln <= n),
f AS (SELECT seg, doc, rank, start, start + length AS "end", cer FROM
 (SELECT *, levenshtein(asr, human) / CAST(length(asr) AS DOUBLE) AS cer FROM k WHERE abs(length(human) - length(asr)) <= lim) WHERE cer * length(asr) <= lim + 0.001
 QUALIFY row_number() OVER (PARTITION BY seg, doc, rank ORDER BY cer, start, length) = 1)"""


def segments(table) -> DataFrame:
    """Passages as a recogniser might hear them: each 7th token lost, each 11th a filler."""
    heard = F.transform(X.words(F.col("text")), lambda x, i: F.when((i + 1) % 7 == 0, None).when((i + 1) % 11 == 0, "um").otherwise(x))
    kept = F.filter(heard, lambda x: x.isNotNull())
    return table("benchmark").select(F.col("item_id").alias("seg"), kept.alias("stoks")).withColumn("asr", F.array_join("stoks", " "))


def transcripts(table) -> DataFrame:
    return table("documents").select(F.col("doc_id").alias("doc"), "text", X.words(F.col("text")).alias("toks"))


def paired(table) -> DataFrame:
    return alignment.pairs(segments(table), transcripts(table))


@query("cer_pairs", f"""WITH {PAIR_SQL} SELECT seg, doc, CAST(greatest(least(lo, n - w), 0) AS INTEGER) AS start,
 round(levenshtein(asr, array_to_string(toks[greatest(least(lo, n - w), 0) + 1 : greatest(least(lo, n - w), 0) + w], ' ')) / CAST(length(asr) AS DOUBLE), 6) AS cer FROM p""")
def cer_pairs(table):
    """Error rate of every passage at its first anchor in every document that shares four words."""
    p = paired(table)
    start = alignment.anchored()
    human = alignment.at(start, F.col("w"))
    return p.select("seg", "doc", start.alias("start"), F.round(alignment.cer(F.col("asr"), human), 6).alias("cer"))


query("cer_pairs_full", ORACLE_SQL["cer_pairs"])(cer_pairs)


@query("align_coarse", f"WITH {COARSE_SQL} SELECT seg, doc, CAST(rank AS INTEGER) AS rank, CAST(pos AS INTEGER) AS pos, round(cer, 6) AS cer FROM co")
def align_coarse(table):
    """The best windows of every pair."""
    return alignment.coarse(paired(table)).select("seg", "doc", "rank", "pos", F.round("cer", 6).alias("cer"))


query("align_coarse_full", ORACLE_SQL["align_coarse"])(align_coarse)


@query("align_fine", f"""WITH {FINE_SQL} SELECT seg, doc, CAST(rank AS INTEGER) AS rank, CAST(start AS INTEGER) AS start, CAST("end" AS INTEGER) AS "end", round(cer, 6) AS cer FROM f""")
def align_fine(table):
    """Start and end of the best text around every one of these."""
    return alignment.fine(alignment.coarse(paired(table))).withColumn("cer", F.round("cer", 6))


query("align_fine_full", ORACLE_SQL["align_fine"])(align_fine)


@query("align_best", f"""WITH {FINE_SQL}, top AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY seg, doc ORDER BY cer, start, "end") = 1)
SELECT p.seg, p.doc, CAST(coalesce(start, greatest(least(lo, n - w), 0)) AS INTEGER) AS start, CAST(coalesce("end", greatest(least(lo, n - w), 0) + w) AS INTEGER) AS "end",
 round(coalesce(cer, levenshtein(asr, array_to_string(toks[greatest(least(lo, n - w), 0) + 1 : greatest(least(lo, n - w), 0) + w], ' ')) / CAST(length(asr) AS DOUBLE)), 6) AS cer,
 CASE WHEN cer IS NULL THEN 'fallback' WHEN cer <= 0.3 THEN 'region' WHEN cer <= 0.45 THEN 'global' ELSE 'fallback' END AS stage FROM p LEFT JOIN top USING (seg, doc)""")
def align_best(table):
    """The match of every passage in every anchored document, with the stage that accepted it."""
    p = paired(table)
    return alignment.best(alignment.fine(alignment.coarse(p)), p).withColumn("cer", F.round("cer", 6))


@query("align_best_full", f"""WITH m AS MATERIALIZED ({ORACLE_SQL["align_best"]}) SELECT * FROM m
UNION ALL SELECT item_id, NULL, NULL, NULL, NULL, 'unmatched' FROM benchmark WHERE item_id NOT IN (SELECT seg FROM m)""")
def align_best_full(table):
    """The same over all documents and whole texts; a passage without an anchor is a row of stage unmatched."""
    p = paired(table)
    got = alignment.best(alignment.fine(alignment.coarse(p)), p)
    return got.unionByName(alignment.unmatched(segments(table), got), allowMissingColumns=True).withColumn("cer", F.round("cer", 6))


@query("align_proven")
def align_proven(table):
    """Accepted matches of all passages in all documents; a passage of stage unmatched is in none of them within the bound."""
    return proven.match(segments(table), transcripts(table)).withColumn("cer", F.round("cer", 6))


def _chunks(table) -> DataFrame:
    """Anchored passages cut into segments of twelve tokens; the first of a pair has the transcript's text."""
    segs, texts = segments(table), transcripts(table)
    near = alignment.nearby(segs, texts)
    p = alignment.pairs(segs, texts, near=near).join(near, "doc")  # only texts that have a pair travel
    n = F.ceil(F.col("w") / 12).cast("int")
    toks = F.split("asr", " ")
    part = p.select("seg", "doc", "toks", toks.alias("st"), F.explode(F.sequence(F.lit(0), n - 1)).alias("seg_idx"))
    return part.select(
        F.concat(F.lit("v"), F.col("seg").cast("string")).alias("video"), F.col("doc").cast("string").alias("transcript"), "seg_idx",
        F.array_join(F.slice("st", F.col("seg_idx") * 12 + 1, 12), " ").alias("asr"),
        F.when(F.col("seg_idx") == 0, F.array_join("toks", " ")).alias("text"))


@query("align_exact")
def align_exact_query(table):
    """Sequential alignment with a cursor; checked against brute force on fixtures."""
    return align_exact.align(_chunks(table)).select("video", "transcript", "seg_idx", "start_idx", "end_idx", F.round("cer", 6).alias("cer"), "error")


@query("align_pipeline")
def align_pipeline(table):
    """Align, then select the best transcript of every passage within the error bound."""
    done = align_exact.align(_chunks(table))
    rows = done.select("video", "transcript", F.lit("txt").alias("format"), "seg_idx", "cer", F.lit(1.0).alias("duration"))
    return selection.select_transcripts(selection.best_format(rows), "best_only", 0.8).select("video", "transcript", "format", F.round("cer", 6).alias("cer"), "segments")


WER_SQL = r"""b AS (SELECT item_id, list_filter(string_split_regex(regexp_replace(regexp_replace(lower(text), '[<\[][^>\]]*[>\]]|\([^)]*\)', '', 'g'), '[\p{M}\p{S}\p{P}]', ' ', 'g'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS t FROM benchmark),
h AS (SELECT item_id, t AS ref, list_filter(list_transform(t, lambda x, i: CASE WHEN i % 7 = 0 THEN NULL WHEN i % 11 = 0 THEN 'um' ELSE x END), lambda x: x IS NOT NULL) AS hyp FROM b),
k AS (SELECT *, list_distinct(list_concat(ref, hyp)) AS v FROM h),
e AS (SELECT item_id, len(ref) AS n, levenshtein(array_to_string(list_transform(hyp, lambda x: chr(CAST(32 + list_position(v, x) AS INTEGER))), ''),
 array_to_string(list_transform(ref, lambda x: chr(CAST(32 + list_position(v, x) AS INTEGER))), '')) AS d FROM k)"""


@query("corpus_wer", f"WITH {WER_SQL} SELECT count(*) AS pairs, CAST(sum(d) AS BIGINT) AS edits, CAST(sum(n) AS BIGINT) AS words, round(100.0 * sum(d) / sum(n), 6) AS wer FROM e")
def corpus_wer(table):
    """Word error rate of perturbed passages against the passages, on normalised whole texts."""
    t = X.words(X.normalise_for_wer(F.col("text")))
    heard = F.transform("ref", lambda x, i: F.when((i + 1) % 7 == 0, None).when((i + 1) % 11 == 0, "um").otherwise(x))
    b = table("benchmark").select("item_id", t.alias("ref")).withColumn("hyp", F.filter(heard, lambda x: x.isNotNull())).where(F.size("ref") > 0)
    e = b.select(X.word_distance(F.col("hyp"), F.col("ref")).alias("d"), F.size("ref").alias("n"))
    return e.agg(F.count("*").alias("pairs"), F.sum("d").cast("long").alias("edits"), F.sum("n").cast("long").alias("words"),
                 F.round(100.0 * F.sum("d") / F.sum("n"), 6).alias("wer"))


query("corpus_wer_full", ORACLE_SQL["corpus_wer"])(corpus_wer)
