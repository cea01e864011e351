"""Exact n-gram Jaccard join by grouped prefixes, and its connected components.

A text's set is its distinct word n-grams, hashed to 64 bits.  Two texts link when the
similarity of their sets is at least THRESHOLD per cent.  With all sets sorted by one
order, rare n-grams first, linked sets share an n-gram in their prefixes; the order comes
from a count sketch of fixed size, and any order gives exact results.

* Texts with equal prefixes and sizes are one group; only groups enter the candidate search.
* Group prefixes are sorted by n-gram, size band and place.  The first group of each band,
  which has the fewest n-grams of its own, is the band's pivot, and every other group is
  first held against the pivots of its band and of the next smaller one.  An n-gram that may
  have more than HOT_ROWS groups is dealt to parts with pivots of their own, and the pivots of
  all its parts are held against each other in the same way.
* Verified links to pivots give components.  The pairs that are left are those of groups
  that share a prefix n-gram, pass the size and place filters and are in different
  components; a pair inside a component cannot change a component, so no hot group of copies
  is expanded to all its pairs.  Their members are verified like the others.
* Candidate pairs of groups are expanded to members, and members are verified on their
  whole sets.

Equal sets are one node throughout (64-bit signatures; at 10^6 different sets the chance of
one false meeting is below 10^-7).

Defined cases: null and empty texts, and texts of white space, have an empty set, link with
nothing and are their own component; fewer words than n are one n-gram of all words; rows
that are repeated link with each other; a null key is never a component's name unless all
its keys are null; an empty table gives no rows.  Other columns are not returned by
`components`; `keep_one` keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.llm import bytesets as B
from stenoflow.llm import common as C
from stenoflow.llm.graph import connected_components

WORDS = 5
#: Per cent of the union that the intersection must reach.
THRESHOLD = 75
SKETCH_BITS = 20
#: Rows of one key beyond which they are dealt to parts, or joined without a shuffle.
HOT_ROWS = 10_000
#: Groups, or sets, that a task remembers in order not to send them twice; more only cost repeats.
REMEMBERED = 1 << 18
#: Most bits of the filter of texts that take part in candidate pairs.
MAX_FILTER_BITS = 1 << 27

_NOT_BLANK = ~B.BLANKS
_TABLE = B.byte_table(True, _NOT_BLANK)
_FACTORS = B.mix64(np.arange(11, 11 + 64, dtype=np.uint64)) | np.uint64(1)
_SHIFT = np.uint64(64 - SKETCH_BITS)


def shingles(buf: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of texts laid end to end, repeats included, and each text's bounds."""
    starts, _, h = B.words(buf, offsets, _NOT_BLANK, _TABLE)
    bounds = B.row_bounds(starts, offsets)
    size = np.diff(bounds)
    if not len(h):
        return h, bounds
    value = np.zeros(len(h), np.uint64)
    for j in range(n):
        value[: len(h) - j] += h[j:] * _FACTORS[j]
    left = np.repeat(bounds[1:], size) - np.arange(len(h))
    keep = left >= n
    for r in np.flatnonzero((size > 0) & (size < n)):
        a, b = bounds[r], bounds[r + 1]
        value[a] = (h[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
        keep[a] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return B.mix64(value[keep]), total[bounds]


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(batch, row, sorted set) of every text."""
    for batch in batches:
        buf, offsets = B.utf8(batch.column("text"))
        for i, j in B.slices(offsets):
            sh, at = shingles(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
            for r in range(j - i):
                s = np.sort(sh[at[r] : at[r + 1]])
                if len(s) > 1:
                    s = s[np.concatenate([[True], s[1:] != s[:-1]])]
                yield batch, i + r, s
        B.give_back()


def _sketch(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        buf, offsets = B.utf8(batch.column("text"))
        for i, j in B.slices(offsets):
            sh, _ = shingles(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
            total += np.bincount((sh >> _SHIFT).astype(np.int64), minlength=len(total))
        B.give_back()
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])


def _rank_table(texts: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Counts of n-grams by the leading bits of their hashes, shifted to 20 bits, and the shift."""
    rows = texts.mapInArrow(partial(_sketch, n=n), "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    table = np.zeros(1 << SKETCH_BITS, np.uint64)
    table[got.column("at").to_numpy()] = got.column("n").to_numpy().astype(np.uint64)
    shift = max(0, int(table.max()).bit_length() - 20)
    return (table >> np.uint64(shift)).astype(np.uint32), shift


def _prefix(s: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The leading part of a set in the common order, as order keys."""
    rank = ranks[(s >> _SHIFT).astype(np.int64)].astype(np.uint64)
    key = np.sort(rank << np.uint64(44) | s >> np.uint64(20))
    return key[: len(s) - -(-percent * len(s) // 100) + 1]


_PLACES = B.mix64(np.arange(1, 1 << 16, dtype=np.uint64))


def _group_of(prefix: np.ndarray, size: int) -> np.uint64:
    places = _PLACES if len(prefix) < len(_PLACES) else B.mix64(np.arange(1, len(prefix) + 1, dtype=np.uint64))
    return B.mix64((B.mix64(prefix) * (places[: len(prefix)] | np.uint64(1))).sum(dtype=np.uint64, keepdims=True) + np.uint64(size))[0]


def _signature(s: np.ndarray) -> np.uint64:
    return B.mix64(B.mix64(s).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(len(s)))[0]


def _identify(batches: Iterator[pa.RecordBatch], n: int, percent: int, ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Signature, size and group of every text; 0 for those without words."""
    for batch in batches:
        sig, size, gid = (np.zeros(batch.num_rows, t) for t in (np.uint64, np.int32, np.uint64))
        for _, r, s in _sets(iter([batch]), n):
            if len(s):
                sig[r], size[r] = _signature(s), len(s)
                gid[r] = _group_of(_prefix(s, ranks, percent), len(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(sig.view(np.int64)), pa.array(size), pa.array(gid.view(np.int64))],
            names=["key", "sig", "n", "gid"],
        )


def _prefix_rows(batches: Iterator[pa.RecordBatch], n: int, percent: int, ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(gram, gid, code) of the prefix of every group; few groups more than once a task.

    The code sorts by size band, then place, and holds the size too.
    """
    seen: set[int] = set()
    out: list[tuple] = []
    held = 0

    def flush():
        cols = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0].view(np.int64)), pa.array(cols[1].view(np.int64)), pa.array(cols[2])],
            names=["gram", "gid", "code"],
        )

    for _, _, s in _sets(batches, n):
        if not len(s):
            continue
        p = _prefix(s, ranks, percent)
        gid = _group_of(p, len(s))
        if int(gid) in seen:
            continue
        if len(seen) >= REMEMBERED:
            seen.clear()
        seen.add(int(gid))
        k = len(p)
        band = int(np.log(len(s)) / np.log(100 / percent) + 1e-9)
        out.append((p, np.full(k, gid), (np.int64(band) << 54) + (np.arange(k, dtype=np.int64) << 27) + len(s)))
        held += k
        if held > 200_000:
            yield flush()
            out, held = [], 0
    if out:
        yield flush()


def _may_link(nx, px, ny, py, percent: int):
    """Whether sizes and places of a shared n-gram leave enough possible overlap."""
    return (100 + percent) * np.minimum(nx - px, ny - py) >= percent * (nx + ny)


#: Rows of one n-gram held back while the next batch may have more of them.
_HELD = 1 << 16


def _pivots(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows of n-grams that several groups share, each with its pivots.

    Rows come sorted by gram, part, code and gid; a part of 0 or more is one of several of its
    gram, which is then shared in any case.  The rows of the last gram of a batch wait for the
    next batch; of a hot gram only the heads of its last two bands do.
    """
    none = np.zeros(0, np.int64)
    rest, hot = [none] * 4, False
    for batch in batches:
        cols = [np.concatenate([r, batch.column(c).to_numpy()]) for r, c in zip(rest, ("gram", "part", "gid", "code"), strict=True)]
        if not len(cols[0]):
            continue
        last = int(np.argmax((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])))
        made, _ = _emit(*[c[:last] for c in cols], percent, hot)
        if made is not None:
            yield made
        hot = hot and not last
        rest = [c[last:] for c in cols]
        if len(rest[0]) > _HELD:
            made, rest = _emit(*rest, percent, True)
            hot = True
            yield made
    made, _ = _emit(*rest, percent, hot)
    if made is not None:
        yield made


_PIVOT_ROWS = "gram long, gid long, code long, part long, head boolean, p1 long, p2 long"


def _emit(gram, part, gid, code, percent: int, go_on: bool):
    """The batch of shared rows with pivots, and the heads of the last two bands.

    go_on: the first gram is known to be shared.
    """
    if not len(gram):
        return None, None
    band, place, n = code >> 54, (code >> 27) & ((1 << 27) - 1), code & ((1 << 27) - 1)
    first_gram = np.concatenate([[True], (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])])
    first_band = first_gram | np.concatenate([[True], band[1:] != band[:-1]])
    gram_at = np.flatnonzero(first_gram)
    group = np.cumsum(first_gram) - 1
    shared = (np.maximum.reduceat(gid, gram_at) != np.minimum.reduceat(gid, gram_at))[group] | (part >= 0)
    if go_on:
        shared |= group == 0
    heads = np.flatnonzero(first_band)
    index = np.cumsum(first_band) - 1
    head, before = heads[index], heads[np.maximum(index - 1, 0)]
    near = (index > 0) & (group[before] == group) & (band[before] == band - 1)
    ok1 = (gid[head] != gid) & _may_link(n, place, n[head], place[head], percent)
    ok2 = near & (gid[before] != gid) & _may_link(n, place, n[before], place[before], percent)
    rows = np.flatnonzero(shared)
    made = None
    if len(rows):
        made = pa.RecordBatch.from_arrays(
            [
                pa.array(gram[rows]), pa.array(gid[rows]), pa.array(code[rows]), pa.array(part[rows]),
                pa.array((head == np.arange(len(gid)))[rows]),
                pa.array(gid[head][rows], mask=~ok1[rows]), pa.array(gid[before][rows], mask=~ok2[rows]),
            ],
            names=["gram", "gid", "code", "part", "head", "p1", "p2"],
        )
    kept = heads[-2:]
    return made, [gram[kept], part[kept], gid[kept], code[kept]]


def _with_pivots(rows: DataFrame, percent: int) -> DataFrame:
    """Shared rows of (gram, part, gid, code) with their pivots."""
    dealt = rows.repartition("gram", "part").sortWithinPartitions("gram", "part", "code", "gid")
    return dealt.mapInArrow(partial(_pivots, percent=percent), _PIVOT_ROWS)


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64(bits - 1)
    return [(B.mix64(h + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & mask).astype(np.int64) for k in (1, 2, 3)]


def _row_hash(sig: np.uint64 | int, key: object) -> np.uint64:
    """Hash of a signature and the key of the row that speaks for it."""
    return np.uint64(int.from_bytes(hashlib.blake2b(repr((int(sig), key)).encode(), digest_size=8).digest(), "little"))


def _filter_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("sig").to_numpy().view(np.uint64), batch.column("key").to_pylist(), strict=True)
        at = np.concatenate(_places(np.array([_row_hash(*p) for p in pairs], np.uint64), bits))
        words, index = np.unique(at >> 5, return_inverse=True)
        value = np.zeros(len(words), np.int64)
        np.bitwise_or.at(value, index, np.int64(1) << (at & 31))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(value)], names=["word", "v"])


def _filter(sigs: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of bounded size over a table of (signature, key)."""
    bits, rows = 1 << 16, sigs.count()
    while bits < min(16 * rows, MAX_FILTER_BITS):
        bits <<= 1
    got = (
        sigs.mapInArrow(partial(_filter_words, bits=bits), "word long, v long")
        .groupBy("word").agg(F.bit_or("v").alias("v")).toArrow()
    )
    words = np.zeros(bits >> 5, np.uint32)
    words[got.column("word").to_numpy()] = got.column("v").to_numpy().astype(np.uint32)
    return words, bits


def _candidate_sets(
    batches: Iterator[pa.RecordBatch], n: int, words: np.ndarray, bits: int
) -> Iterator[pa.RecordBatch]:
    """(sig, set) of the rows that the filter lets through; few signatures more than once a task."""
    seen: set[int] = set()
    sig, data, held = [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(sig, np.uint64).view(np.int64)), pa.array(data, pa.binary())], names=["sig", "grams"]
        )

    for batch, r, s in _sets(batches, n):
        if not len(s):
            continue
        x = _signature(s)
        h = np.array([_row_hash(x, batch.column("key")[r].as_py())])
        if int(x) in seen or not all(int(words[p[0] >> 5]) >> (p[0] & 31) & 1 for p in _places(h, bits)):
            continue
        if len(seen) >= REMEMBERED:
            seen.clear()
        seen.add(int(x))
        sig.append(x)
        data.append(s.tobytes())
        held += 8 * len(s)
        if held > 8 << 20:
            yield flush()
            sig.clear()
            data.clear()
            held = 0
    if sig:
        yield flush()


@F.arrow_udf(T.LongType())
def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        both = np.sort(np.concatenate([s, t]), kind="stable")
        out.append(int((both[1:] == both[:-1]).sum()))
    return pa.array(out, pa.int64())


def _verify(pairs: DataFrame, texts: DataFrame, speakers: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of signatures whose sets are similar enough.

    Of the rows with one signature, the one that speaks for it sends its set; the join below
    drops what the filter let through by chance.
    """
    pairs = C.cut(pairs)
    if pairs.isEmpty():
        return pairs
    needed = C.cut(pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct().join(speakers, "sig"))
    words, bits = _filter(needed)
    sets = texts.mapInArrow(
        partial(_candidate_sets, n=n, words=words, bits=bits), "sig long, grams binary"
    ).groupBy("sig").agg(F.first("grams").alias("grams"))
    one = sets.select(F.col("sig").alias("a"), F.col("grams").alias("ga"))
    two = sets.select(F.col("sig").alias("b"), F.col("grams").alias("gb"))
    size = lambda c: F.octet_length(c) / 8
    return (
        pairs.join(one, "a").join(two, "b")
        .select("a", "b", _overlap("ga", "gb").alias("i"), (size("ga") + size("gb")).alias("both"))
        .where((100 + percent) * F.col("i") >= percent * F.col("both"))
        .select("a", "b")
    )


def _expand(groups: DataFrame, nodes: DataFrame, extra: list[str]) -> DataFrame:
    """Members (a, b) of pairs (x, y) of groups."""
    pick = lambda g, m: nodes.select(F.col("gid").alias(g), F.col("sig").alias(m), *[F.col(c).alias(f"{c}_{m}") for c in extra])
    return groups.join(pick("x", "a"), "x").join(pick("y", "b"), "y")


def _links(texts: DataFrame, ids: DataFrame, ranks: np.ndarray, shift: int, n: int, percent: int) -> DataFrame:
    """(sig, comp, least) of every signature: its component and the least key in it."""
    nodes = C.cut(ids.where("n > 0").groupBy("sig").agg(F.first("gid").alias("gid"), F.min("key").alias("key")))
    speakers = nodes.select("sig", "key")
    rows = texts.mapInArrow(
        partial(_prefix_rows, n=n, percent=percent, ranks=ranks), "gram long, gid long, code long"
    )
    # the leading bits of a gram in the common order are its count in the sketch
    parts = F.ceil(F.shiftleft(F.shiftrightunsigned("gram", 44), shift) / HOT_ROWS)
    part = F.when(parts > 1, F.pmod(F.xxhash64("gid"), parts)).otherwise(F.lit(-1)).cast("long")
    shared = C.cut(_with_pivots(rows.withColumn("part", part), percent))
    heads = shared.where("head and part >= 0").select("gram", F.lit(-1).cast("long").alias("part"), "gid", "code").distinct()
    pivots = shared.union(_with_pivots(heads, percent)).select("gid", F.explode(F.array("p1", "p2")).alias("pivot"))
    reps = nodes.groupBy("gid").agg(F.min("sig").alias("rep"))
    star = (
        pivots.where("pivot is not null").distinct()
        .join(reps.select(F.col("gid").alias("pivot"), F.col("rep").alias("b")), "pivot")
        .join(nodes, "gid").select(F.col("sig").alias("a"), "b")
    )
    inside = nodes.join(reps, "gid").select(F.col("sig").alias("a"), F.col("rep").alias("b"))
    tried = C.cut(_ordered(star.union(inside)))
    C.release(texts.sparkSession)
    first = connected_components(_verify(tried, texts, speakers, n, percent))
    member = C.cut(
        nodes.join(first, nodes["sig"] == first["node"], "left")
        .select("sig", "gid", "key", F.coalesce("component", "sig").alias("comp"))
    )
    C.release(texts.sparkSession)
    groups = C.cut(member.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")))
    bits = (1 << 27) - 1
    placed = C.look_up(
        shared.select("gram", "gid", F.col("code").bitwiseAND(bits).alias("n"), F.shiftright("code", 27).bitwiseAND(bits).alias("place")),
        groups, "gid", HOT_ROWS,
    )
    open_grams = placed.groupBy("gram").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).where("l <> h")
    live = C.cut(placed.join(open_grams.select("gram"), "gram", "left_semi").dropDuplicates(["gram", "gid"]))
    C.release(texts.sparkSession)
    x, y = live.alias("x"), live.alias("y")
    c = F.col
    left = F.least(c("x.n") - c("x.place"), c("y.n") - c("y.place"))
    settled = (c("x.lo") == c("x.hi")) & (c("y.lo") == c("y.hi")) & (c("x.lo") == c("y.lo"))
    apart = (
        x.join(
            y,
            (c("x.gram") == c("y.gram")) & (c("x.gid") < c("y.gid")) & ~settled
            & ((100 + percent) * left >= percent * (c("x.n") + c("y.n"))),
        )
        .select(c("x.gid").alias("x"), c("y.gid").alias("y")).distinct()
    )
    split = groups.where("lo <> hi").select(c("gid").alias("x"), c("gid").alias("y"))
    pairs = _expand(apart.union(split), member, ["comp"]).where("comp_a <> comp_b").select("a", "b")
    more = _verify(_ordered(pairs).join(tried, ["a", "b"], "left_anti"), texts, speakers, n, percent)
    # links between components join components, so only these are walked again
    comp = lambda k: member.select(F.col("sig").alias(k), F.col("comp").alias(f"c{k}"))
    merged = connected_components(more.join(comp("a"), "a").join(comp("b"), "b").select("ca", "cb"), "ca", "cb")
    merged = merged.select(F.col("node").alias("comp"), F.col("component").alias("to"))
    last = C.cut(C.look_up(member, merged, "comp", HOT_ROWS).select("sig", "key", F.coalesce("to", "comp").alias("comp")))
    least = last.groupBy("comp").agg(F.min("key").alias("least"))
    return C.look_up(last.drop("key"), C.cut(least), "comp", HOT_ROWS)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(
    df: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = THRESHOLD
) -> DataFrame:
    """One row per row of df: key, sig (of its set), n_shingles, node (one for each component, null
    for an empty set), component (its least key)."""
    C.ship(df.sparkSession)
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    only = texts.select("text")
    ranks, shift = _rank_table(only, n)
    kind = texts.schema["key"].dataType.simpleString()
    ids = C.cut(
        texts.mapInArrow(
            partial(_identify, n=n, percent=percent, ranks=ranks), f"key {kind}, sig long, n int, gid long"
        )
    )
    found = C.cut(_links(texts, ids, ranks, shift, n, percent))
    C.release(df.sparkSession)
    # copies share a signature: a hot one is not shuffled to one task
    return C.look_up(ids, found, "sig", HOT_ROWS).select(
        "key", "sig", F.col("n").cast("long").alias("n_shingles"), F.col("comp").alias("node"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component"),
    )


def _group_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """(x, y): all pairs of groups that share a prefix n-gram and pass the size and place filters, once each.

    The groups of an n-gram are dealt to parts of HOT_ROWS at most, and each part meets all groups of the n-gram.
    """
    c, bits = F.col, (1 << 27) - 1
    rows = C.cut(shared.select(
        "gram", "gid", c("code").bitwiseAND(bits).alias("n"), F.shiftright("code", 27).bitwiseAND(bits).alias("place")
    ).dropDuplicates(["gram", "gid"]))
    parts = rows.groupBy("gram").agg(F.ceil(F.count("*") / HOT_ROWS).alias("parts"), F.count("*").alias("held")).where("held > 1")
    rows = rows.join(parts.drop("held"), "gram")
    x = rows.withColumn("part", F.pmod(F.xxhash64("gid"), c("parts"))).alias("x")
    y = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), c("parts") - 1))).alias("y")
    left = F.least(c("x.n") - c("x.place"), c("y.n") - c("y.place"))
    near = (100 + percent) * left >= percent * (c("x.n") + c("y.n"))
    met = x.join(y, (c("x.gram") == c("y.gram")) & (c("x.part") == c("y.part")) & (c("x.gid") < c("y.gid")) & near)
    return met.select(c("x.gid").alias("x"), c("y.gid").alias("y")).distinct()


def links(
    df: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = THRESHOLD
) -> DataFrame:
    """One row per row of df: key, n_shingles, component (its least key), and n_links, the number of other rows that
    it links with, copies of its own text and of others counted one by one.

    Pairs of different sets are verified within components too, each pair of sets once however many copies it
    has; so unlike those of `components`, time and disk grow with the number of such links.
    """
    C.ship(df.sparkSession)
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    ranks, _ = _rank_table(texts.select("text"), n)
    kind = texts.schema["key"].dataType.simpleString()
    ids = C.cut(texts.mapInArrow(partial(_identify, n=n, percent=percent, ranks=ranks), f"key {kind}, sig long, n int, gid long"))
    nodes = C.cut(ids.where("n > 0").groupBy("sig").agg(F.first("gid").alias("gid"), F.min("key").alias("key"), F.count("*").alias("copies")))
    shared = texts.mapInArrow(partial(_prefix_rows, n=n, percent=percent, ranks=ranks), "gram long, gid long, code long")
    same = nodes.groupBy("gid").agg(F.count("*").alias("sets")).where("sets > 1").select(F.col("gid").alias("x"), F.col("gid").alias("y"))
    pairs = _ordered(_expand(_group_pairs(shared, percent).union(same), nodes, []).select("a", "b"))
    found = C.cut(_verify(pairs, texts, nodes.select("sig", "key"), n, percent))
    ends = found.select(F.col("a").alias("sig"), F.col("b").alias("other")).union(found.select("b", "a"))
    others = ends.join(nodes.select(F.col("sig").alias("other"), "copies"), "other").groupBy("sig").agg(F.sum("copies").alias("others"))
    joined = connected_components(found).select(F.col("node").alias("sig"), F.col("component").alias("comp"))
    comp = C.cut(nodes.join(joined, "sig", "left").join(others, "sig", "left").select(
        "sig", "key", F.coalesce("comp", "sig").alias("comp"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    least = C.cut(comp.groupBy("comp").agg(F.min("key").alias("least")))
    known = C.cut(C.look_up(comp.drop("key"), least, "comp", HOT_ROWS).drop("comp"))
    return C.look_up(ids, known, "sig", HOT_ROWS).select(
        "key", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).alias("n_links"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return components(C.table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(t[i : i + 4], ' ') AS gram
  FROM w, unnest(range(1, greatest(len(t) - 3, 2))) AS u(i) WHERE len(t) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM g a JOIN g b USING (gram) JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
c AS (SELECT a, b FROM p UNION SELECT c.a, p.b FROM c JOIN p ON p.a = c.b)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, coalesce(min(b), doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = doc_id GROUP BY doc_id
"""


def _signatures(n: int):
    @F.arrow_udf(T.LongType())
    def sig(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), np.uint64)
        for _, r, s in _sets(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), n):
            out[r] = _signature(s) if len(s) else 0
        return pa.array(out.view(np.int64))

    return sig


def keep_one(df: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = WORDS) -> DataFrame:
    """df with one row of each component, the one with the least key and text.

    Rows with an empty set all stay.  Texts are joined with the bounded table of kept keys and
    not shuffled; only rows whose key is not unique are looked at again by their sets.
    """
    which = C.cut(components(df, key=key, text=text, n=n))
    first = which.where(F.col("key").eqNullSafe(F.col("component")))
    counted = which.groupBy("key").agg(F.count("*").alias("all")).where("all > 1").select("key", F.lit(True).alias("many"))
    kept = first.select(F.col("key").alias("k")).distinct()
    kept = C.cut(kept.join(counted, kept["k"].eqNullSafe(counted["key"]), "left").select("k", "many"))
    small = C.within_bytes(kept.count(), 110)
    # the row is one column, so its names meet no other
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{key}`").alias("rk"),
        F.col(f"`{text}`").cast("string").alias("t"),
    )
    rows = rows.join(F.broadcast(kept) if small else kept, F.col("rk").eqNullSafe(F.col("k")))
    cols = [F.col(f"row.`{c}`").alias(c) for c in df.columns]
    again = rows.where("many").withColumn("s", _signatures(n)(F.col("t")))
    sure = first.select("key", "sig", "node").distinct()
    again = again.join(sure, F.col("k").eqNullSafe(F.col("key")) & (F.col("s") == F.col("sig")))
    one = Window.partitionBy("k", "node").orderBy(F.col("t").asc_nulls_last(), "row")
    chosen = again.withColumn("rank", F.row_number().over(one)).where("rank = 1 or node is null")
    return rows.where("many is null").select(*cols).union(chosen.select(*cols))
