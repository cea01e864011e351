"""Periodic runs of words, from maximal pairs.

A maximal pair is two places of a text at which the same stretch of words begins, with different
words before and after.  If the stretch is at least so long as the places are apart, the pair
spans a run: its distance is a period, and the run is known whole, without extending anything.  A
run of exponent e asks for stretches of e - 1 distances, so a long run is met once for each
multiple of its period that leaves enough repetitions; the least distance is kept.

For a text, suffixes that share their first four words with another one are sorted by prefix
doubling, in which only suffixes that are not yet alone take part; neighbours' common prefixes
(LCP) are counted in text order.  LCP intervals are visited bottom-up with a stack.  Each holds the
places of its suffixes, all together and in lists by the word on their left.  When two children
meet at a common length, the places of the smaller are sought in the larger within a third of that
length, in the lists of other left words alone or, where these are more than the places in reach,
in the places.  Places in reach of one another belong to one run, and all but its first have the
same left word, so hardly a pair is looked at that is not reported.  Prose without
repetitions has few shared stretches and costs little more than its reading.

Defined cases: a null or empty text has no run and nothing to collapse (an empty text); words
are split at ASCII white space and compared as they are; runs may overlap; of equal rows each
gets its result; texts are read whole, of any length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.llm import common as C
from stenoflow.llm import duck

#: Least length in words and least exponent of a run.
LEAST, EXPONENT = 6, 4
#: Suffixes alone with their first words of this number take no part.
PREFIX = 4


def _suffixes(codes: np.ndarray) -> np.ndarray:
    """Sorted suffixes that share their first PREFIX codes with a neighbour."""
    n = len(codes)
    rank = codes.astype(np.int64)
    held = np.arange(n)
    alone = np.zeros(n, bool)
    width = 0  # codes that the ranks cover; 0: ranks are codes
    while len(held):
        after = held + max(width, 1)
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1) if width else np.zeros(len(held), np.int64)
        order = np.lexsort((second, rank[held]))
        held, first, second = held[order], rank[held][order], second[order]
        at = np.arange(len(held))
        old = np.r_[True, first[1:] != first[:-1]]
        new = old | np.r_[True, second[1:] != second[:-1]]
        heads = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[held] = heads if not width else first + heads - np.maximum.accumulate(np.where(old, at, 0))
        ends = np.r_[new[1:], True]
        width = 2 * width or 1
        if width <= PREFIX:
            alone[held[new & ends]] = True
        held = held[~(new & ends)]
    shared = np.flatnonzero(~alone)
    return shared[np.argsort(rank[shared])]


def _common(codes: list[int], suffixes: list[int]) -> dict[int, int]:
    """Length that each suffix shares with its neighbour before, by place."""
    before = dict(zip(suffixes[1:], suffixes, strict=False))
    end = len(codes)
    codes = [*codes, -1]
    shared, length, last = {}, 0, 0
    for i in sorted(suffixes):
        # what is left of the last length holds for i, where it is more than the suffixes taken part for
        length, last = length - (i - last), i
        length = length if length >= PREFIX else 0
        j = before.get(i)
        if j is None:
            length = 0
        else:
            while i + length < end and j + length < end and codes[i + length] == codes[j + length]:
                length += 1
        shared[i] = length
    return shared


class _Places:
    """Places of an interval: all in order, and in lists by the word on their left."""

    __slots__ = ("all", "left")

    def __init__(self, place: int, left: int):
        self.all, self.left = [place], {left: [place]}

    def near(self, place: int, left: int, reach: int, words: Sequence[int]) -> list[int]:
        """Places within reach that have another word on their left."""
        low, high = bisect_left(self.all, place - reach), bisect_right(self.all, place + reach)
        if high - low <= len(self.left):
            return [y for y in self.all[low:high] if words[y] != left]
        out = []
        for word, places in self.left.items():
            if word != left:
                out += places[bisect_left(places, place - reach) : bisect_right(places, place + reach)]
        return out

    def take(self, other: _Places) -> None:
        for mine, more in [(self.all, other.all), *[(self.left.setdefault(w, []), p) for w, p in other.left.items()]]:
            if len(more) == 1:
                insort(mine, more[0])
            else:
                mine.extend(more)
                mine.sort()


def maximal_pairs(codes: Sequence[int], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(first place, distance, common length) of all maximal pairs whose distance leaves room for a run."""
    suffixes = _suffixes(np.asarray(codes)).tolist() if len(codes) >= least else []
    codes = list(codes)
    shared = _common(codes, suffixes)
    words = [-1, *codes]  # words[i]: left of place i
    floor = least - least // exponent  # no shorter stretch makes a run
    pairs: list[tuple[int, int, int]] = []

    def meet(a: _Places, b: _Places, length: int) -> _Places:
        large, small = (a, b) if len(a.all) >= len(b.all) else (b, a)
        reach = length // (exponent - 1)
        for x in small.all:
            for y in large.near(x, words[x], reach, words):
                distance = abs(x - y)
                if distance + length >= least:
                    pairs.append((min(x, y), distance, length))
        large.take(small)
        return large

    stack: list[tuple[int, _Places]] = []
    for k, place in enumerate(suffixes):
        node = _Places(place, words[place])
        length = shared[suffixes[k + 1]] if k + 1 < len(suffixes) else 0
        while stack and stack[-1][0] > length:
            common, places = stack.pop()
            node = meet(places, node, common)
        if stack and stack[-1][0] == length:
            stack[-1] = length, meet(stack[-1][1], node, length)
        elif length >= floor:
            stack.append((length, node))
    return pairs


def runs(codes: Sequence[int], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    found: dict[tuple[int, int], int] = {}
    for start, distance, length in maximal_pairs(codes, least, exponent):
        whole = start, distance + length
        found[whole] = min(found.get(whole, distance), distance)
    return sorted((start, length, period) for (start, length), period in found.items() if length >= max(least, exponent * period))


def _words(text: str) -> list[bytes]:
    """Words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def _read(text: str | None) -> tuple[list[tuple[int, int, int]], str]:
    words = _words(text or "")
    seen: dict[bytes, int] = {}
    codes = np.fromiter(map(seen.setdefault, words, count()), np.int64, len(words))
    found = runs(codes)
    if found:
        kept = np.ones(len(words), bool)
        for start, length, period in found:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return sorted(found, key=lambda r: (r[0], r[2])), b" ".join(words).decode("utf-8", "surrogatepass")


RUN = T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("period", T.LongType())
RESULT = T.StructType().add("runs", T.ArrayType(RUN)).add("collapsed", T.StringType())


def _result(texts: pa.Array) -> pa.Array:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    rows, collapsed = [], []
    for text in texts:
        found, rest = _read(text.as_py())
        rows.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
        collapsed.append(rest)
    return pa.StructArray.from_arrays([pa.array(rows, pa.list_(run)), pa.array(collapsed, pa.string())], ["runs", "collapsed"])


def detect(df: DataFrame, *, text: str = "text", to: tuple[str, str] = ("runs", "collapsed")) -> DataFrame:
    """df with the runs of each text, by start and period, and its text without their repetitions, words joined by blanks."""
    C.ship(df.sparkSession)
    found = F.arrow_udf(_result, RESULT)
    name, out = C.free_name(df, "__runs"), C.free_name(df, "__result")
    held = df.withColumn(out, found(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))
    renamed = F.struct(F.col(f"`{out}`.runs").alias(to[0]), F.col(f"`{out}`.collapsed").alias(to[1]))
    return C.replace_columns(held.withColumn(name, renamed).drop(out), name, list(to))


def most_repeated(found: Column) -> Column:
    """The run with the greatest exponent, null without runs; ties: the first."""

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        first = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))
        return F.when((x > y) | ((x == y) & first), -1).when((x == y) & (a["start"] == b["start"]) & (a["period"] == b["period"]), 0).otherwise(1)

    return F.get(F.array_sort(found, order), F.lit(0))


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; one text in ten goes on as repetitions of a stretch, which the id and the length choose."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1).cast("long"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", words.alias("w"), F.expr("0L").alias("zero"), h.alias("h")).withColumn("n", F.size("w").cast("long"))
    g = F.floor(F.col("h") / 10)
    cut = cut.withColumn("a", F.when(F.col("n") > 0, g % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    stretch = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(stretch, times)), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), again), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, repetitions planted in one document of ten."""
    found = detect(_planted(C.table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = most_repeated(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: Runs from pairs of equal five-word stretches: neighbouring pairs at one distance make a stretch of their own.
OP12_SQL = f"""WITH h AS (SELECT doc_id, row_number() OVER () AS r, {duck.crc32("CAST(doc_id AS VARCHAR)")} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS m FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + m) AS p FROM g),
d AS (SELECT doc_id, r, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
q AS (SELECT r, n, i, hash(w[i + 1 : i + 5]) AS gram FROM d, unnest(range(0, greatest(n - 4, 0))) AS u(i)),
e AS (SELECT x.r, x.i, y.i - x.i AS q FROM q x JOIN q y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e),
l AS (SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM s GROUP BY r, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
t AS (SELECT r, start, length, min(q) AS period FROM l GROUP BY ALL),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / CAST(period AS DOUBLE) DESC, start, period) = 1),
k AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM t GROUP BY r),
o AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM t),
f AS (SELECT r, array_agg(i) AS gone FROM o GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
 sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i - 1)) END, ' ')) AS collapsed_sha256
FROM d LEFT JOIN b USING (r) LEFT JOIN k USING (r) LEFT JOIN f USING (r)"""
