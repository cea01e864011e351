"""Selection of quantiles, nested bins, inferred types, and small readers and writers."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stenoflow.operators import quantiles as Q
from stenoflow.operators import timeline as TL
from stenoflow.sources import readers, writers

SHARES = [0.0, 0.1, 0.15, 0.5, 0.9, 1.0]


def test_quantiles(spark):
    r = random.Random(3)
    groups = {
        "spread": [r.lognormvariate(0, 40) * r.choice([-1, 1]) for _ in range(300)], "close": [1.0 + r.random() * 1e-12 for _ in range(200)],
        "ties": [2.5] * 150 + [7.0] * 20, "one": [-3.0], "small": [5e-324, -5e-324, 0.0, -0.0, 1e308, -1e308], None: [float(i) for i in range(7)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {(x.g, x.share): x["quantile"] for x in Q.quantiles(df, "v", SHARES, ["g"]).collect()}
    assert set(got) == {(g, s) for g in groups for s in SHARES}
    for (g, s), v in got.items():
        ordered = sorted(groups[g])
        at = (len(ordered) - 1) * s
        a, b = ordered[math.floor(at)], ordered[math.ceil(at)]
        assert v == (a if a == b else a + (b - a) * (at - math.floor(at)))
    whole = Q.quantiles(df.where("g = 'spread'"), "v", [0.5]).collect()
    assert [x["quantile"] for x in whole] == [np.median(groups["spread"])]
    assert Q.quantiles(df.limit(0), "v", [0.5]).collect() == []


def test_quantiles_of_infinite_values(spark):
    df = spark.createDataFrame([(v,) for v in (float("-inf"), 1.0, 2.0, float("inf"))], "v double")
    assert [x["quantile"] for x in Q.quantiles(df, "v", [0.0, 1 / 3, 1.0]).orderBy("share").collect()] == [float("-inf"), 1.0, float("inf")]


def test_a_long_interval_is_a_few_rows(spark):
    spans = [(0.0, 1e7), (59.0, 61.0), (-1e6, 1e9), (5.0, 5.0), (None, 3.0)]
    df = spark.createDataFrame(spans, "a double, b double").withColumn("bins", TL._bins(F.col("a"), F.col("b"), TL.BIN))
    for x in df.where("a IS NOT NULL").collect():
        assert 1 <= len(x.bins) <= 2 * (2 + math.log2(1 + (x.b - x.a) / TL.BIN))
        covered = sorted((n.bin * 2**n.level, (n.bin + 1) * 2**n.level) for n in x.bins)
        assert covered[0][0] == x.a // TL.BIN and covered[-1][1] == x.b // TL.BIN + 1
        assert all(p[1] == q[0] for p, q in zip(covered, covered[1:], strict=False))


def test_crops_and_overlaps_of_any_length(spark):
    r = random.Random(5)
    span = lambda: (lambda a: (a, a + r.choice([0.0, 3, 90, 5000, 1e6])))(round(r.uniform(-500, 20_000), 1))
    s = [("v", *span()) for _ in range(80)] + [("w", 0.0, 1e7)]
    w = [(r.choice("vvw"), k, *span()) for k in range(60)]
    got = TL.crop(spark.createDataFrame(s, "video string, start double, end double"), spark.createDataFrame(w, "video string, w int, w_start double, w_end double"))
    want = [(v, k, max(a, c), min(b, d)) for v, a, b in s for x, k, c, d in w if v == x and a < d and b > c]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 300
    said = [(v, a, b, i % 3) for i, (v, a, b) in enumerate(s)]
    late = TL.overlaps(spark.createDataFrame(said, "video string, start double, end double, label int"), "video", "label").collect()
    meet = {}
    for v, a, b, n in said:
        until = [d for x, c, d, m in said if x == v and m != n and c <= a < d]
        if until:
            meet[v, a, b, n] = max(until)
    assert {tuple(x)[:4]: x.until for x in late} == meet


def test_crops_by_a_grid(spark):
    r = random.Random(7)
    s = [("v" if i % 3 else "w", a, a + r.choice([-40.0, 0.0, 3, 90, 5000, 1e6])) for i in range(200) for a in [round(r.uniform(-500, 20_000), 1)]]
    s += [("v", None, 3.0), ("v", 5.0, float("-inf")), ("x", 90_000.0, 90_030.0)]
    timeline = spark.createDataFrame(s, "video string, start double, end double")
    for every, length in ((1800.0, 900.0), (100.0, 250.0)):
        want = [(v, k, max(a, k * every), min(b, k * every + length)) for v, a, b in s if a is not None
                for k in range(48) if a < k * every + length and b > k * every]
        got = TL.crop_grid(timeline, every, length, 48)
        assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 200


@pytest.mark.parametrize("name", ["interval_crop", "interval_crop_rows"])
def test_a_grid_of_windows_is_not_joined(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Join" not in plan and "window" in plan.lower()


def test_inferred_types(spark, tmp_path):
    text = "id,n,share,day,flag,mixed,blank,text\n007,1,0.5,2024-01-31,True,1,,a\n8,-2,1,2023-12-01,False,x,,2024-13-01\n9, ,1e3,,True,2024-01-01, ,\n"
    (tmp_path / "m.csv").write_text(text)
    path = str(tmp_path / "m.csv")
    got = readers.typed_manifest(spark, path, keep=("id",))
    assert dict(got.dtypes) == {"id": "string", "n": "bigint", "share": "double", "day": "date", "flag": "boolean", "mixed": "string", "blank": "string", "text": "string"}
    assert got.first().id == "007" and [x.n for x in got.collect()] == [1, -2, None]
    # what pandas takes for numbers and truth values, this does as well
    kinds = {"i": "bigint", "f": "double", "b": "boolean"}
    for c, kind in pd.read_csv(path, skipinitialspace=True).dtypes.items():
        if c not in ("n", "blank", "id"):  # pandas makes floats of whole numbers beside blanks, and of blank columns
            assert readers.inferred_types(readers.manifest(spark, path))[c] == kinds.get(kind.kind, "date" if c == "day" else "string")
    assert readers.inferred_types(spark.createDataFrame([("9" * 30,), ("1",)], "big string")) == {"big": "double"}


def test_whole_texts_and_tables(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "t" / "b.txt").write_text("")
    got = {x.path.rsplit("/", 1)[1]: x.content for x in readers.whole_texts(spark, str(tmp_path / "t")).collect()}
    assert got == {"a.txt": "one\ntwo\n"}
    df = spark.createDataFrame([("1", 'a "quoted", cell'), ("2", None)], "id string, link string")
    out = str(tmp_path / "csv")
    writers.table_csv(df.coalesce(1), out)
    assert sorted(map(tuple, readers.manifest(spark, out).collect())) == [("1", 'a "quoted", cell'), ("2", None)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.table_csv(df, out)
    writers.append(spark.createDataFrame([("3", "c")], "id string, link string").coalesce(1), out)
    assert sorted(x.id for x in readers.manifest(spark, out).collect()) == ["1", "2", "3"]
    writers.report(df.agg(F.count("*").alias("rows")), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().rows == 2
