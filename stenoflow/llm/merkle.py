"""Merkle manifest of a dataset, with a proof for every row, by butterfly exchange.

Every row is a leaf: the hash of its fields.  Within a group (a source) leaves ascend by key,
and every FANOUT consecutive nodes become their hash until one is left, the group's subroot;
the subroots, ordered by group, give the root in the same way.

The ranks of the rows deal a group to aligned blocks of FANOUT * FANOUT leaves.  A block
hashes its two lowest levels alone.  From then on blocks exchange roots round by round: in
round r the blocks at the same place of FANOUT neighbouring subtrees of FANOUT ** r blocks meet,
each learns the others' roots, appends them to its proof and hashes the parent, as the others
do.  So every block ends with the subroot and with its whole upper proof, and nothing is handed
down.  Where the last subtree is not full, its blocks also stand for the places that it lacks.
A meeting has FANOUT rows at most, whatever the size of the group, and a round moves a row for
each block.

Rows with the same key in a group are ordered by their leaf's hash.  A proof is a list with one
entry for each level from the leaf to the root: the hashes left and right of the path's node in
its run, joined; both are empty where a node is alone in its run.

Defined cases: a null field counts as `-`, a null group sorts first, a null key sorts first in its
group; an empty table has no rows and no root; equal rows are leaves of their own; texts are
hashed whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stenoflow.llm import common as C
from stenoflow.llm import duck
from stenoflow.llm.ranks import ranked

FANOUT = 16
_PATH = "array<struct<left:string,right:string>>"


def h(*parts: Column) -> Column:
    """SHA-256 of the parts' UTF-8 texts, one after another, as lower-case hexadecimal."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encode(field: Column) -> Column:
    """A field as its size in bytes, a colon and its value; a null as a dash."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return h(*[encode(f) for f in fields])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(path, start, lambda acc, x: h(x["left"], acc, x["right"]))


def siblings(path: Column) -> Column:
    """All hashes of a proof, joined."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def _beside(nodes: Column, i: Column, fanout: int) -> Column:
    """The proof's entry of node i of a run."""
    return F.struct(
        F.array_join(F.slice(nodes, F.lit(1), i), "").alias("left"),
        F.array_join(F.slice(nodes, i + 2, F.lit(fanout)), "").alias("right"),
    )


def _levels(n: Column, fanout: int) -> Column:
    """Levels above n leaves: none for one leaf."""
    powers = [fanout**k for k in range(64) if fanout**k < 1 << 62]
    return F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < n))


def _blocks(rows: DataFrame, fanout: int) -> DataFrame:
    """(key, block, total, runs, node): each block's runs of members, and its root.

    rows: key, rank, total, leaf (binary), and more columns, which members carry.
    """
    members = F.struct("rank", "leaf", *[F.col(c) for c in rows.columns if c not in ("key", "rank", "total", "leaf")])
    placed = rows.withColumns({
        "run": F.expr(f"rank div {fanout}"), "block": F.expr(f"rank div {fanout * fanout}"), "member": members,
    }).select("key", "block", "run", "total", "member")
    hexed = lambda m: F.lower(F.hex(m["leaf"]))
    # both groupings use the one shuffle by block
    runs = placed.repartition("key", "block").groupBy("key", "block", "run").agg(
        F.sort_array(F.collect_list("member")).alias("members"), F.first("total").alias("total")
    ).withColumn("node", h(F.array_join(F.transform("members", hexed), "")))
    blocks = runs.groupBy("key", "block").agg(
        F.sort_array(F.collect_list(F.struct("run", "members", "node"))).alias("runs"), F.first("total").alias("total"))
    levels, nodes = _levels(F.col("total"), fanout), F.col("runs")["node"]
    node = F.when(levels == 0, hexed(F.col("runs")[0]["members"][0])).when(levels == 1, nodes[0]).otherwise(h(F.array_join(nodes, "")))
    return blocks.withColumn("node", node)


def _exchange(state: DataFrame, r: int, fanout: int) -> DataFrame:
    """One round: (key, block, blocks, node, path) of live blocks to the same, one level higher."""
    size = fanout**r
    placed = state.withColumns({
        "subtree": F.expr(f"block div {size}"), "own": F.expr(f"block % {size}"),
    }).withColumns({"parent": F.expr(f"subtree div {fanout}"), "digit": F.expr(f"subtree % {fanout}")})
    full = F.least(F.lit(size), F.col("blocks") - F.col("subtree") * size)
    # the last subtree may have too few blocks to meet all the others' ones
    places = F.when((full < size) & (F.col("digit") > 0), F.sequence("own", F.lit(size - 1).cast("long"), full.cast("long"))).otherwise(F.array("own"))
    sent = placed.withColumn("place", F.explode(places))
    met = sent.groupBy("key", "parent", "place").agg(F.sort_array(F.collect_list(F.struct(
        "digit", "node", (F.col("place") == F.col("own")).alias("real"), "block", "blocks", "path"))).alias("m"))
    met = met.select("key", "m", h(F.array_join(F.col("m")["node"], "")).alias("node"))
    higher = F.transform("m", lambda x, i: F.struct(
        x["real"].alias("real"), x["block"].alias("block"), x["blocks"].alias("blocks"),
        F.concat(x["path"], F.array(_beside(F.col("m")["node"], i, fanout))).alias("path")))
    return met.select("key", "node", F.explode(F.filter(higher, lambda x: x["real"])).alias("x")).select(
        "key", "x.block", "x.blocks", "node", "x.path")


def _upper(blocks: DataFrame, fanout: int) -> DataFrame:
    """(key, block, root, path): what every block knows after the last round."""
    per = fanout * fanout
    live = blocks.select(
        "key", "block", F.expr(f"(total + {per - 1}) div {per}").alias("blocks"), "node", F.array().cast(_PATH).alias("path"))
    most = live.agg(F.max("blocks")).first()[0] or 0
    done, r = [], 0
    while fanout**r < most:
        ended = F.col("blocks") <= fanout**r
        done.append(live.where(ended))
        live = C.cut(_exchange(live.where(~ended), r, fanout))
        r += 1
    for d in done:
        live = live.unionByName(d)
    return live.select("key", "block", F.col("node").alias("root"), "path")


def tree(leaves: DataFrame, order: list[str], fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """(blocks, upper) of written leaves: key (text, not null), leaf (binary), the columns of order, and more."""
    blocks = C.cut(_blocks(ranked(leaves, ["key"], [*order, "leaf"]), fanout))
    return blocks, C.cut(_upper(blocks, fanout))


def _joined(left: DataFrame, right: DataFrame, on: list[str], row_bytes: int) -> DataFrame:
    """left with the columns of a table that holds each key once; it is broadcast if its size is small."""
    return left.join(F.broadcast(right) if C.within_bytes(right.count(), row_bytes, 32 << 20) else right, on)


def _spread(blocks: DataFrame, upper: DataFrame, fanout: int) -> DataFrame:
    """A row for each member, with its columns, path and root and the other columns of upper."""
    both = _joined(blocks.drop("node"), upper, ["key", "block"], 4096)
    kept = [c for c in upper.columns if c not in ("key", "block", "path")]
    levels, none = _levels(F.col("total"), fanout), F.array().cast(_PATH)
    runs = F.transform("runs", lambda x, i: F.struct(
        x["members"].alias("members"), x["members"]["leaf"].alias("leaves"),
        F.when(levels > 1, F.array(_beside(F.col("runs")["node"], i, fanout))).otherwise(none).alias("above")))
    by_run = both.select("key", *kept, "path", levels.alias("levels"), F.explode(runs).alias("run")).select(
        "key", *kept, "levels", F.col("run.members").alias("members"), F.concat("run.above", "path").alias("above"),
        F.transform("run.leaves", lambda x: F.lower(F.hex(x))).alias("nodes"))
    low = F.transform("members", lambda x, i: F.struct(
        x.alias("m"), F.when(F.col("levels") > 0, F.array(_beside(F.col("nodes"), i, fanout))).otherwise(none).alias("low")))
    rows = by_run.select("key", *kept, "above", F.explode(low).alias("x"))
    return rows.select("key", "x.m.*", *kept, F.concat("x.low", "above").alias("path"))


def manifest(
    df: DataFrame, fields: Sequence[str], *, key: str = "doc_id", group: str = "source",
    also: dict[str, Column] | None = None, fanout: int = FANOUT,
) -> DataFrame:
    """(key, group, rank, leaf, subroot, root, path) of every row; also: more columns, computed beside the leaf.

    The root commits to all rows; fold(leaf, path) gives it back for every row.
    """
    name = F.col(f"`{group}`").cast("string")
    # a text that sorts nulls first and others bytewise
    kept = {"id": F.col(f"`{key}`"), **{f"also_{k}": v for k, v in (also or {}).items()}}
    leaves = C.cut(df.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("key"),
        F.unhex(leaf(*[F.col(f"`{f}`") for f in fields])).alias("leaf"), *[v.alias(k) for k, v in kept.items()]))
    blocks, upper = tree(leaves, ["id"], fanout)
    subroots = upper.where("block = 0").select(F.lit("").alias("key"), F.unhex("root").alias("leaf"), F.col("key").alias("id"))
    top = _spread(*tree(C.cut(subroots), ["id"], fanout), fanout).select(
        F.col("id").alias("key"), "root", F.col("path").alias("over"))
    upper = _joined(upper.withColumnRenamed("root", "subroot"), top, ["key"], 4096)
    upper = C.cut(upper.select("key", "block", "subroot", "root", F.concat("path", "over").alias("path")))
    rows = _spread(blocks, upper, fanout)
    return rows.select(
        F.col("id").alias(key), F.when(F.col("key") != "", F.substr("key", F.lit(2))).alias(group), "rank",
        F.lower(F.hex("leaf")).alias("leaf"), "subroot", "root", "path", *[F.col(f"also_{k}").alias(k) for k in also or {}])


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and each proof tried on a row that may have been changed."""
    docs = C.table(spark, sf_dir, "documents").select(*FIELDS)
    changed = leaf(*[F.translate("text", UPPER, LOWER) if f == "text" else F.col(f) for f in FIELDS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.unhex(changed))
    rows = manifest(docs, FIELDS, also={"tampered": tampered})
    rows = rows.withColumn("folded_root", fold(F.coalesce(F.lower(F.hex("tampered")), "leaf"), F.col("path")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", h(siblings(F.col("path"))).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _levels_sql(rows: str, levels: int, tag: str) -> str:
    """CTEs over rows (key, pos, n, node): run lists {tag}r0, ... and nodes {tag}n1, ..., one for each level."""
    out, nodes = [], rows
    for k in range(levels):
        out.append(f"""{tag}r{k} AS (SELECT key, pos // 16 AS run, n, array_agg(node ORDER BY pos) AS nodes FROM {nodes} GROUP BY ALL),
{tag}n{k + 1} AS (SELECT key, run AS pos, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node FROM {tag}r{k})""")
        nodes = f"{tag}n{k + 1}"
    return ",\n".join(out)


def _paths_sql(rows: str, levels: int, tag: str, to: str) -> str:
    """CTEs that append to rows (key, place, path) an entry of each level that has more than one node."""
    out = []
    for k in range(levels):
        name = f"{tag}p{k}" if k < levels - 1 else to
        out.append(f"""{name} AS (SELECT p.* REPLACE (place // 16 AS place, CASE WHEN n > 1 THEN list_append(path,
 {{'l': array_to_string(nodes[1 : place % 16], ''), 'r': array_to_string(nodes[place % 16 + 2 :], '')}}) ELSE path END AS path)
 FROM {rows} p JOIN {tag}r{k} r ON r.key = p.key AND r.run = p.place // 16)""")
        rows = name
    return ",\n".join(out)


def _leaf_sql(text: str) -> str:
    return "sha256(concat(" + ", ".join(
        f"coalesce(concat(strlen(CAST({f} AS VARCHAR)), ':', {f}), '-')" for f in (*FIELDS[:-1], text)) + "))"


#: The same for up to 16 ** 5 rows of a source and 16 ** 3 sources.
OP11_SQL = f"""WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS key, {_leaf_sql('text')} AS leaf, {duck.crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 AS hit,
 CASE WHEN hit THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE leaf END AS tried FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n, leaf AS node FROM d),
{_levels_sql('l', 5, 's')},
t AS (SELECT '' AS key, key AS source, node, row_number() OVER (ORDER BY encode(key)) - 1 AS pos, count(*) OVER () AS n FROM sn5),
{_levels_sql('t', 3, 't')},
lp AS (SELECT doc_id, key, leaf, tried, pos AS place, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) AS path FROM l),
{_paths_sql('lp', 5, 's', 'low')},
mid AS (SELECT doc_id, leaf, tried, low.path AS path, t.pos AS place, '' AS key, t.node AS subroot FROM low JOIN t ON t.source = low.key),
{_paths_sql('mid', 3, 't', 'whole')},
f AS (SELECT doc_id, leaf, subroot, (SELECT node FROM tn3) AS root,
 sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
 list_reduce(list_prepend({{'l': tried, 'r': ''}}, path), lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l AS folded_root FROM whole)
SELECT *, folded_root = root AS verified FROM f"""
