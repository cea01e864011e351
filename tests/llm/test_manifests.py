"""Merkle manifests and shards against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stenoflow.llm import merkle, ranks, sharding


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves, fanout):
    """Root, and for each leaf its (left, right) entries."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // fanout * fanout : (p // fanout + 1) * fanout]
            paths[i].append(("".join(run[: p % fanout]), "".join(run[p % fanout + 1 :])))
        nodes = [h(*nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        at = [p // fanout for p in at]
    return nodes[0], paths


def plain_manifest(rows, fanout):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row[0]))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])], fanout) for s in order}
    root, above = plain_tree([trees[s][0] for s in order], fanout)
    out = Counter()
    for s, over in zip(order, above, strict=True):
        for x, path in zip(sorted(by_source[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            out[(x[3], x[2], trees[s][0], root, tuple(path + over))] += 1
    return out


def rows_of(seed, sources, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(sources) if rng.random() < 0.6 else sources[0]  # a hot source
        rows.append((rng.choice([None, i, i, i, i, 7]), source, rng.choice(["en", None]), rng.choice([None, 3]), rng.choice([None, "", "Text É", f"T{i}"])))
    return rows + rows[:20]


@pytest.mark.parametrize("fanout,n,sources", [(2, 150, [None, "a", "É", "b", "", "Z"]), (3, 200, ["x"]), (2, 60, [str(i) for i in range(25)]), (16, 300, ["a", "b"]), (2, 1, ["a"])])
def test_manifest(spark, fanout, n, sources):
    rows = rows_of(n, sources, n)[:n]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    got = merkle.manifest(df, merkle.FIELDS, fanout=fanout).withColumns({
        "folded": merkle.fold(F.col("leaf"), F.col("path")), "other": merkle.fold(F.lit(h("other")), F.col("path"))}).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((x.left, x.right) for x in r.path)) for r in got) == plain_manifest(rows, fanout)
    assert all(r.folded == r.root and r.other != r.root for r in got)


def test_manifest_query(spark):
    """Every row is verified unless its text really changes."""
    got = merkle.op11_merkle(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in got.join(docs, "doc_id").collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None and any("A" <= c <= "Z" for c in r.text)
        assert r.verified == (not changed)


def test_manifest_empty(spark, odd):
    assert merkle.manifest(odd.where("false"), ["doc_id", "text"]).collect() == []


def test_ranks(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaab"), rng.randrange(5)) for _ in range(500)] + [("a", 1)] * 400
    got = ranks.ranked(spark.createDataFrame(rows, "g string, x int").repartition(5), ["g"], ["x"]).collect()
    for g in "ab":
        own = sorted((r["rank"], r.x) for r in got if r.g == g)
        assert [k for k, _ in own] == list(range(len(own))) and [x for _, x in own] == sorted(x for y, x in rows if y == g)
        assert {r.total for r in got if r.g == g} == {len(own)}


def plain_pack(sizes, capacity):
    left, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(left) if r >= s]
        if not fits:
            left.append(max(capacity, s))
        i = min(fits)[1] if fits else len(left) - 1
        left[i] -= s
        out.append(i)
    return out


def test_pack():
    rng = random.Random(1)
    for _ in range(150):
        sizes = sorted([rng.randrange(1, 100) for _ in range(rng.randrange(400))], reverse=True)
        capacity = rng.randrange(50, 300)
        want = plain_pack(sizes, capacity)
        assert sharding.pack(sizes, capacity) == want
        shards = len(set(want))
        assert sharding.pack(sizes, capacity, shards) == want
        assert not shards or sharding.pack(sizes, capacity, shards - 1) is None


def test_balance():
    rng = random.Random(2)
    for n in (0, 1, 5, 40, 400, 5000):
        sizes = sorted([int(rng.lognormvariate(6, 1)) + 16 for _ in range(n)] + ([40_000] * (n > 50)), reverse=True)
        loads = [0] * 40
        for s, b in zip(sizes, sharding.balance(sizes, 40), strict=True):
            loads[b] += s
        if n >= 400:
            # what stands alone aside, shards are as even as the smallest groups allow
            shared = sorted(loads)[: -1 if n < 5000 else None]
            assert max(shared) - min(shared) <= 0.05 * max(shared)


def shards_hold(rows, texts, shards):
    by_text, by_shard = defaultdict(set), defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
        assert 0 <= r.shard < shards
    for s in by_shard.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
        ids = [r.doc_id for r in sorted(s, key=lambda r: r.slot)]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
    crc = {t: zlib.crc32((t or "").encode()) for t in texts}
    assert Counter(r.text_crc32 for r in rows) == Counter(crc[t] for t in texts)
    assert Counter(r["size"] for r in rows) == Counter(len((t or "").encode()) + 16 for t in texts)
    for r in rows:
        by_text[r.text_crc32, r["size"]].add(r.shard)
    return by_text, by_shard


@pytest.mark.parametrize("grain", [500, 3])
def test_shards(spark, grain):
    rng = random.Random(4)
    texts = ["copy é"] * 300 + [f"text {i} " + "w" * int(rng.lognormvariate(4, 1)) for i in range(600)] + [None] * 3 + [""] * 2
    rows = [(rng.choice([None, 5, i, i, i]), t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(4)
    got = sharding.assign(df, shards=7, grain=grain).collect()
    by_text, by_shard = shards_hold(got, texts, 7)
    assert all(len(v) == 1 for k, v in by_text.items() if k[1] > 16)
    loads = [sum(r["size"] for r in s) for s in by_shard.values()]
    assert len(loads) == 7 and max(loads) <= (1.02 if grain == 500 else 1.5) * sum(loads) / 7
    again = sharding.assign(df.repartition(2), shards=7, grain=grain).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_shards_hot(spark, odd):
    """A group larger than a mean shard stands alone, and the rest is still even."""
    texts = ["hot " * 50] * 400 + [f"text {i}" * 5 for i in range(800)]
    got = sharding.assign(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=10).collect()
    loads = sorted(sum(r["size"] for r in got if r.shard == k) for k in range(10))
    assert loads[-1] == 400 * 216 and loads[-2] - loads[0] <= 60
    assert sharding.assign(odd.where("false")).collect() == []
