"""Benchmark decontamination by pigeonhole edit matching.

Texts and benchmark items are read as lower-cased words between single blanks.  An item
of m characters may be found with k = floor(m x EDIT_RATE) edits, so of its k + 1 equal
pieces at least one occurs in the text unchanged: all pieces are sought at once with one
automaton, and every hit is verified by Myers' bit-parallel edit distance of the item
within the window that the hit allows.

An item that is too short for an edit is found only as whole words; a longer one may begin or
end inside a word, which the edits allow.

The benchmark side is a query set: its items go to the tasks in blocks of at most
BLOCK_BYTES.  With more than one block there is one pass over the texts for each, written as a
table before the next, so driver, plan and tasks hold one block at a time.

Defined cases: null and empty texts contain nothing; null and empty items, and items
without a word, are never found; an item with a null id is found like any other, and its hits
have a null item; ids are of any type; repeated items are each reported; of equal best matches
of an item the one that ends first is reported; very long texts are read whole; other columns
stay, and a column named like a result is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stenoflow.llm import bytesets as B
from stenoflow.llm import common as C

#: Edits allowed, as a share of an item's characters.
EDIT_RATE = 0.06
#: Bytes of items per pass over the texts.
BLOCK_BYTES = 8 << 20

_GAP = re.compile(r"[\W_]+")


def normalise(text: str) -> str:
    return _GAP.sub(" ", text.lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of nearly equal length, with their places."""
    n, parts = len(item), min(budget + 1, len(item))
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(pattern_masks: dict[str, int], m: int, text: str, limit: int) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and the end of the first such part.

    (limit + 1, -1) if it is above the limit.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, at = limit + 1, -1
    for j, c in enumerate(text, 1):
        eq = pattern_masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph <<= 1
        mh <<= 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
        if score < best:
            best, at = score, j
    return best, at


def _masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        self.items = []
        self.automaton = ahocorasick.Automaton()
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for number, raw in items:
            item = normalise(raw)
            if not item:
                continue
            budget = int(len(item) * rate)
            place = len(self.items)
            self.items.append((number, item, budget, _masks(item), _masks(item[::-1])))
            for a, piece in pieces(item, budget):
                by_piece.setdefault(piece, []).append((place, a))
        for piece, where in by_piece.items():
            self.automaton.add_word(piece, (len(piece), where))
        if by_piece:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[dict]:
        """Best match of every item within its budget: item, distance, start and end in the normalised text."""
        if not self.items or not text:
            return []
        body = normalise(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (length, where) in self.automaton.iter(body):
            for place, a in where:
                item, budget = self.items[place][1:3]
                start = last + 1 - length - a
                if not budget and not _whole_words(body, start, last + 1):
                    continue
                windows.setdefault(place, []).append((start - budget, start + len(item) + budget))
        found = []
        for place, spans in sorted(windows.items()):
            number, item, budget, masks, backward = self.items[place]
            best = (budget + 1, -1)
            done = -1
            for a, b in _merged(spans):
                a = max(a, 0, done)
                distance, end = myers(masks, len(item), body[a:b], min(budget, best[0] - 1))
                if distance < best[0]:
                    best = (distance, a + end)
                if best[0] == 0:
                    break
            if best[0] <= budget:
                distance, end = best
                low = max(0, end - len(item) - distance)
                _, size = myers(backward, len(item), body[low:end][::-1], distance)
                found.append({"item": number, "distance": distance, "start": end - size, "end": end})
        return found


def _whole_words(body: str, start: int, end: int) -> bool:
    return (start == 0 or body[start - 1] == " ") and (end == len(body) or body[end] == " ")


def _merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Unions of overlapping spans, in order."""
    a, b = None, None
    for x, y in sorted(spans):
        if a is None:
            a, b = x, y
        elif x <= b:
            b = max(b, y)
        else:
            yield a, b
            a, b = x, y
    yield a, b


_matchers: dict[str, Matcher] = {}


def _matcher(block: str, items: list[tuple[object, str]], rate: float) -> Matcher:
    """The worker's matcher of a block, compiled once."""
    if block not in _matchers:
        _matchers.clear()
        _matchers[block] = Matcher(items, rate)
    return _matchers[block]


def _hit_type(item: T.DataType) -> T.ArrayType:
    hit = T.StructType().add("item", item).add("distance", T.IntegerType()).add("start", T.IntegerType()).add("end", T.IntegerType())
    return T.ArrayType(hit)


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, str]]]:
    block, held = [], 0
    rows = benchmark.select(F.col(f"`{item}`").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    for r in rows.where("t is not null").orderBy("i", "t").toLocalIterator():
        block.append((r["i"], r["t"]))
        held += len(r["t"])
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def _search(items: list[tuple[object, str]], rate: float, kind: T.ArrayType):
    block, arrow = uuid.uuid4().hex, to_arrow_type(kind)

    @F.arrow_udf(kind)
    def hits(column: pa.Array) -> pa.Array:
        matcher = _matcher(block, items, rate)
        found = pa.array([matcher.find(x) if x else [] for x in column.to_pylist()], arrow)
        B.give_back()
        return found

    return hits


def find(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    rate: float = EDIT_RATE,
    to: str = "contamination",
) -> DataFrame:
    """df with an array of (item, distance, start, end): the best match of every item found."""
    C.ship(df.sparkSession)
    name, found = C.free_name(df, "__found"), C.free_name(df, "__hits")
    kind = _hit_type(benchmark.schema[item].dataType)
    t = F.col(f"`{text}`").cast("string")
    got = df.withColumn(found, F.array().cast(kind))
    for number, block in enumerate(_blocks(benchmark, item, item_text)):
        got = C.cut(got) if number else got
        got = got.withColumn(found, F.concat(found, _search(block, rate, kind)(t)))
    return C.replace_columns(got.withColumn(name, F.struct(F.col(found).alias(to))).drop(found), name, [to])


def clean(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of df in which no benchmark item is found."""
    name = C.free_name(df, "__contamination")
    return find(df, benchmark, to=name, **options).where(F.size(F.col(name)) == 0).drop(name)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, a row for each document and item."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = find(docs, C.table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", F.explode("contamination").alias("c")).select(
        "doc_id", F.col("c.item").alias("item_id"), "c.distance", F.col("c.start").alias("start"), F.col("c.end").alias("end")
    )
