"""Secret scan: patterns, and sliding-window Shannon entropy per character class.

Three base patterns give spans of assignments, access keys and hexadecimal keys.  The
entropy method adds spans: candidate strings are runs of key characters that mix letters
and digits; a window moves over each candidate, its character counts are updated by one
character in and one out, and so is the sum of c log2 c, which gives the window's entropy.
Long candidates are read in overlapping pieces, so the cost is in proportion to the text.
The threshold depends on the candidate's character class (hexadecimal or mixed).  Windows
at or above it are joined to spans.  The allow-list holds placeholders and counting
sequences.  With fragments, as the query and the pipeline scan, a match of it is cut out of
the candidate and the pieces beside it are measured, an anchored pattern drops a candidate
that it matches, and candidates of letters alone are measured with a threshold of their
own.  Without, a match anywhere drops the whole candidate, and so does a lack of digits.
Base spans always stay.

Offsets are code points of the whole text, ends exclusive.  Spans that begin together are
ordered as the kinds are listed.

Defined cases: a null text is read as empty and has no span; other columns stay, and a
column named like a result is replaced; repeated rows get equal results; an empty table
gives no rows.  Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stenoflow.llm import common as C

#: The base patterns, the group whose length counts, and the least length.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = {
    "assign": (ASSIGN, 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Least entropy, in bits, of a window of hexadecimal and of mixed characters.
HEX_BITS = 3.0
MIXED_BITS = 3.7
#: The same for candidates without a digit, where they are measured; prose reaches less.
LETTER_BITS = 3.9
#: Candidates that match any of these are no secrets.
ALLOW = (
    r"(?i)example|sample|placeholder|dummy|changeme|your[_-]?",
    r"(?i)abcdefgh|01234567|12345678|deadbeef",
    r"(.)\1{7,}",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)

#: Windows of a candidate, elements of an array and characters of a text that are worked on
#: together; they change no result, only keep the cost in proportion to length.
PIECE, CHUNK, BLOCK = 64, 128, 4096

_SPANS = "array<struct<start:int,end:int,text:string>>"


def _let(value: Column, then) -> Column:
    """then(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(values: Column, step, zero: Column) -> Column:
    """For every element, the fold of those before it; in chunks, so that no long array is copied at each step."""

    def within(part: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out"))
        add = lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(part, start, add, lambda acc: acc["out"])

    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / CHUNK).cast("int") - 1, F.lit(0))),
        lambda k: F.slice(values, k * CHUNK + 1, F.lit(CHUNK)),
    )
    joined = lambda c: F.arrays_zip(c.alias("part"), within(F.transform(c, lambda p: F.aggregate(p, zero, step))).alias("before"))
    shifted = lambda x: F.transform(within(x["part"]), lambda v: step(v, x["before"]))
    return F.flatten(_let(chunks, lambda c: F.transform(joined(c), shifted)))


def _sums(values: Column) -> Column:
    return _running(values, lambda a, b: a + b, F.lit(0))


def _matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches whose group has the least length, as (start, end, text)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

    def placed(hits: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(hits)), lambda g: F.char_length(g))
        rows = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), held.alias("held"))
        return _let(rows, lambda r: F.transform(
            F.arrays_zip(r.alias("x"), _sums(F.transform(r, lambda x: x["gap"] + F.char_length(x["hit"]))).alias("before")),
            lambda y: F.struct(
                (y["before"] + y["x"]["gap"]).alias("start"), (y["before"] + y["x"]["gap"] + F.char_length(y["x"]["hit"])).alias("end"),
                y["x"]["hit"].alias("text"), F.char_length(y["x"]["held"]).alias("n"),
            ),
        ))

    spans = F.transform(F.filter(_let(found, placed), lambda s: s["n"] >= least), lambda s: F.struct(s["start"], s["end"], s["text"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _hot_flags(piece: Column, most: Column) -> Column:
    """For every window of a piece, 1 if it is hot and 0 if not, as a string.

    Counts are one sign for each character of the alphabet; taking in a character and letting
    one go changes two of them and adds two terms to the sum of c log2 c.
    """
    weights = F.array(*[F.lit(c * math.log2(c) if c > 1 else 0.0) for c in range(WINDOW + 2)])
    weigh = lambda c: F.element_at(weights, c + 1)
    code = lambda i: F.instr(F.lit(ALPHABET), F.substring(piece, i, F.lit(1)))
    count = lambda counts, at: F.ascii(F.substring(counts, at, F.lit(1))) - 64
    put = lambda counts, n, at: F.overlay(counts, F.char(n + 64), at, F.lit(1))
    zero = F.struct(F.lit("@" * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"), F.lit("").alias("flags"))

    def step(acc: Column, i: Column) -> Column:
        """Takes in character i and lets character i - WINDOW go; i counts from 1."""
        gone = F.when(i > WINDOW, code(i - WINDOW)).otherwise(0)
        left = _let(
            F.struct(gone.alias("at"), F.when(i > WINDOW, count(acc["counts"], gone)).otherwise(0).alias("n")),
            lambda g: F.struct(
                F.when(g["at"] > 0, put(acc["counts"], g["n"] - 1, g["at"])).otherwise(acc["counts"]).alias("counts"),
                F.when(g["at"] > 0, acc["sum"] + weigh(g["n"] - 1) - weigh(g["n"])).otherwise(acc["sum"]).alias("sum"),
                code(i).alias("came"),
            ),
        )
        taken = _let(left, lambda g: _let(
            F.struct(count(g["counts"], g["came"]).alias("n"), g.alias("g")),
            lambda h: F.struct(
                put(h["g"]["counts"], h["n"] + 1, h["g"]["came"]).alias("counts"),
                (h["g"]["sum"] + weigh(h["n"] + 1) - weigh(h["n"])).alias("sum"),
            ),
        ))
        flag = lambda t: F.when(i < WINDOW, "").when(t["sum"] <= most + 1e-9, "1").otherwise("0")
        return _let(taken, lambda t: F.struct(t["counts"], t["sum"], F.concat(acc["flags"], flag(t)).alias("flags")))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(piece)), zero, step, lambda acc: acc["flags"])


def _bounded(candidate: Column) -> Column:
    """The candidate with the greatest sum of c log2 c of a hot window, which depends on the whole candidate and so is taken once."""
    word = candidate["text"]
    bits = F.when(word.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$"), HEX_BITS).when(~word.rlike("[0-9]"), LETTER_BITS).otherwise(MIXED_BITS)
    most = WINDOW * (F.log2(F.lit(float(WINDOW))) - bits)
    return F.struct(candidate["start"].alias("start"), word.alias("text"), most.alias("most"))


def _hot_windows(candidate: Column) -> Column:
    """Spans (start, end) of a candidate (start, text, most) in which windows reach the entropy of its class.

    The candidate is read in pieces of PIECE windows, so its length costs no more than its characters.
    """
    word = candidate["text"]
    pattern = F.lit(rf"(.{{1,{PIECE}}})(?=(.{{0,{WINDOW - 1}}}))")
    pieces = F.zip_with(
        F.regexp_extract_all(word, pattern, F.lit(1)), F.regexp_extract_all(word, pattern, F.lit(2)), lambda a, b: F.concat(a, b)
    )
    flags = F.array_join(F.transform(pieces, lambda p: _hot_flags(p, candidate["most"])), "")
    apart = f"0{{{WINDOW},}}"

    def spans(f: Column) -> Column:
        runs = F.arrays_zip(F.split(f, apart, -1).alias("run"), F.regexp_extract_all(f, F.lit(apart), F.lit(0)).alias("gap"))
        length = lambda r: F.char_length(r["run"]) + F.coalesce(F.char_length(r["gap"]), F.lit(0))
        placed = lambda r: F.arrays_zip(r.alias("r"), _sums(F.transform(r, length)).alias("at"))
        begin = candidate["start"]
        return F.transform(
            F.filter(_let(runs, placed), lambda x: F.contains(x["r"]["run"], F.lit("1"))),
            lambda x: F.struct(
                (begin + x["at"] + F.instr(x["r"]["run"], F.lit("1")) - 1).alias("start"),
                (begin + x["at"] + F.char_length(F.rtrim(x["r"]["run"], F.lit("0"))) + WINDOW - 1).alias("end"),
            ),
        )

    return _let(flags, spans)


def _without(pieces: Column, pattern: str) -> Column:
    """The pieces (start, end, text) with the matches of a pattern cut out."""

    def cut(piece: Column) -> Column:
        rows = F.arrays_zip(
            F.split(piece["text"], pattern, -1).alias("gap"), F.regexp_extract_all(piece["text"], F.lit(pattern), F.lit(0)).alias("hit")
        )
        length = lambda x: F.char_length(x["gap"]) + F.coalesce(F.char_length(x["hit"]), F.lit(0))
        rest = _let(rows, lambda r: F.transform(
            F.arrays_zip(r.alias("x"), _sums(F.transform(r, length)).alias("at")),
            lambda y: F.struct(
                (piece["start"] + y["at"]).alias("start"), (piece["start"] + y["at"] + F.char_length(y["x"]["gap"])).alias("end"),
                y["x"]["gap"].alias("text"),
            ),
        ))
        return F.when(piece["text"].rlike(pattern), rest).otherwise(F.array(piece))

    return F.flatten(F.transform(pieces, cut))


def _fragments(text: Column, allow: tuple[str, ...]) -> Column:
    """What is measured: candidates without what the allow-list matches."""
    pieces = _matches(text, CANDIDATE, 0, WINDOW)
    whole = [p for p in allow if p.startswith("^")]
    if whole:
        pieces = F.filter(pieces, lambda c: ~reduce(lambda a, b: a | b, [c["text"].rlike(p) for p in whole]))
    for p in allow:
        pieces = pieces if p in whole else _without(pieces, p)
    likely = F.filter(pieces, lambda c: (F.char_length(c["text"]) >= WINDOW) & c["text"].rlike("[A-Za-z]"))
    return F.transform(likely, _bounded)


def _candidates(text: Column, allow: tuple[str, ...]) -> Column:
    """The same for whole candidates."""
    mixes = r"[0-9][+/_=-]{0,19}[A-Za-z]|[A-Za-z][+/_=-]{0,19}[0-9]"
    likely = F.filter(
        _matches(text, CANDIDATE, 0, WINDOW),
        lambda c: c["text"].rlike(mixes) & ~reduce(lambda a, b: a | b, [c["text"].rlike(p) for p in allow]),
    )
    return F.transform(likely, _bounded)


def scan(
    df: DataFrame, *, text: str = "text", to: str = "secrets", allow: tuple[str, ...] = ALLOW, fragments: bool = False
) -> DataFrame:
    """df with an array of (kind, start, end), ordered by start, then as the kinds are listed."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    name, measured = C.free_name(df, "__found"), C.free_name(df, "__measured")

    def kind(order: int, label: str, spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(order).alias("o"), s["end"].alias("end"), F.lit(label).alias("kind")
            ),
        )

    found = [kind(i, k, _matches(t, *p)) for i, (k, p) in enumerate(KINDS.items())]
    found.append(kind(len(KINDS), "entropy", F.flatten(F.transform(measured, _hot_windows))))
    listed = F.transform(
        F.array_sort(F.concat(*found)), lambda s: F.struct(s["kind"], s["start"], s["end"])
    )
    # a column of its own: the analyzer resolves nested functions a level at a time, and up to a limit
    held = df.withColumn(measured, (_fragments if fragments else _candidates)(t, allow))
    return C.replace_columns(held.withColumn(name, F.struct(listed.alias(to))).drop(measured), name, [to])


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every span, or union of overlapping spans, replaced by the mask."""
    ends = lambda x: F.transform(x, lambda s: s["end"])

    def piece(blocks: Column, begin: Column, end: Column) -> Column:
        """Part of the text, sought in its blocks and not from its start."""
        first = F.floor(begin / BLOCK).cast("int")
        some = F.slice(blocks, first + 1, F.floor(end / BLOCK).cast("int") - first + 1)
        return F.substring(F.array_join(some, ""), begin - first * BLOCK + 1, end - begin)

    def masked(b: Column) -> Column:
        # the end of all spans before each: a span that begins beyond it begins a mask
        reached = F.arrays_zip(spans.alias("s"), _running(ends(spans), lambda x, y: F.greatest(x, y), F.lit(0)).alias("to"))
        kept = F.filter(reached, lambda x: x["s"]["start"] >= x["to"])
        parts = F.transform(kept, lambda x: F.concat(piece(b, x["to"], x["s"]["start"]), F.lit(mask)))
        rest = _let(F.array_max(ends(spans)), lambda e: piece(b, e, F.greatest(F.char_length(text), e)))
        return F.concat(F.array_join(parts, ""), rest)

    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(blocks, masked)).otherwise(text)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, fragments=True).drop("text")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )


def _sql() -> str:
    """op1_secrets for an engine without back references: each span is placed by the lengths before it."""
    quoted = lambda p: p.replace("'", "''")
    before = lambda items, n: f"coalesce(list_sum(list_transform({items}[1:{n}], lambda s: length(s))), 0)"
    run = "|".join(f"[{c}]{{8,}}" for c in ALPHABET)
    cuts = [run if p.startswith("(.)") else p for p in ALLOW if not p.startswith("^")]
    whole = [p for p in ALLOW if p.startswith("^")]
    parts = ["d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"]

    def matches(name: str, pattern: str, group: int) -> str:
        p = quoted(pattern)
        return f"""{name}_m AS (SELECT r, regexp_extract_all(t, '{p}', 0) AS h, regexp_extract_all(t, '{p}', {group}) AS x, string_split_regex(t, '{p}') AS g FROM d),
{name} AS (SELECT r, {before('g', 'i')} + {before('h', 'i - 1')} AS s, h[i] AS w, x[i] AS held FROM {name}_m, unnest(range(1, len(h) + 1)) AS u(i))"""

    found = []
    for o, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        parts.append(matches(kind, pattern, group))
        found.append(f"SELECT r, {o} AS o, '{kind}' AS kind, s, s + length(w) AS e FROM {kind} WHERE length(held) >= {least}")
    parts.append(matches("cand", CANDIDATE, 0))
    parts.append("c0 AS (SELECT r, s, w FROM cand WHERE " + " AND ".join(f"NOT regexp_matches(w, '{quoted(p)}')" for p in whole or ["^$"]) + ")")
    for k, pattern in enumerate(cuts):
        p = quoted(pattern)
        parts.append(f"""c{k}_m AS (SELECT r, s, regexp_extract_all(w, '{p}', 0) AS h, string_split_regex(w, '{p}') AS g FROM c{k}),
c{k + 1} AS (SELECT r, s + {before('g', 'i - 1')} + {before('h', 'i - 1')} AS s, g[i] AS w FROM c{k}_m, unnest(range(1, len(g) + 1)) AS u(i))""")
    parts.append(f"""win AS (SELECT r, s, i, substr(w, i + 1, {WINDOW}) AS v,
 CASE WHEN regexp_matches(w, '^([0-9a-f]+|[0-9A-F]+)$') THEN {HEX_BITS} WHEN NOT regexp_matches(w, '[0-9]') THEN {LETTER_BITS} ELSE {MIXED_BITS} END AS bits
 FROM c{len(cuts)}, unnest(range(0, length(w) - {WINDOW - 1})) AS u(i) WHERE length(w) >= {WINDOW} AND regexp_matches(w, '[A-Za-z]')),
hot AS (SELECT r, s, i, lag(i) OVER (PARTITION BY r, s ORDER BY i) AS p FROM win
 WHERE list_sum(list_transform(list_distinct(string_split(v, '')), lambda c: ({WINDOW} - length(replace(v, c, ''))) * log2({WINDOW} - length(replace(v, c, '')))))
  <= {WINDOW} * (log2({WINDOW}) - bits) + 1e-9),
span AS (SELECT r, s, i, count(*) FILTER (p IS NULL OR i - p > {WINDOW}) OVER (PARTITION BY r, s ORDER BY i) AS k FROM hot)""")
    found.append(f"SELECT r, {len(KINDS)} AS o, 'entropy' AS kind, s + min(i) AS s, s + max(i) + {WINDOW} AS e FROM span GROUP BY r, s, k")
    parts.append("a AS (" + "\nUNION ALL ".join(found) + ")")
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o, e){}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)
    base, every = joined.format(" FILTER (kind <> 'entropy')"), joined.format(" FILTER (kind IS NOT NULL)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT any_value(doc_id) AS doc_id, {counts}, sha256({base}) AS base_sha256, {every} AS spans FROM d LEFT JOIN a USING (r) GROUP BY r"


OP1_SQL = _sql()
