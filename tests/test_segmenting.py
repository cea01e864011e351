"""Segmentation with speakers against a plain restatement, and as a stream."""

import random

from stenoflow.operators import segmenting as SG
from stenoflow.streaming import segments


def restated(duration, silences, labels, least=10.0, most=20.0):
    """Every step looks at everything."""
    overlaps = sorted({(max(a[0], b[0]), min(a[1], b[1])) for a in labels for b in labels if a[2] != b[2] and max(a[0], b[0]) < min(a[1], b[1])})
    crop = lambda rows, lo, hi: sorted((max(r[0], lo), min(r[1], hi), *r[2:]) for r in rows if r[0] < hi and r[1] > lo)
    longest = lambda lo, hi: max(crop(silences, lo, hi), key=lambda s: (s[1] - s[0], -s[0]), default=None)
    cur, out = 0.0, []
    while cur < duration:
        quiet = longest(cur, cur + most)
        if quiet and quiet[0] == cur and quiet[1] - quiet[0] > least:
            cur = quiet[1]
            continue
        shared = [o for o in overlaps if o[0] < cur + most and o[1] > cur]
        if shared:
            cur = shared[0][1] + 1e-6
            continue
        heard = crop(labels, cur, cur + most)
        changes = [h[0] for h in heard if h[2] != heard[0][2] and h[0] > cur]
        if changes:
            cut = changes[0]
        else:
            quiet = longest(cur + least, cur + most)
            cut = (quiet[0] + quiet[1]) / 2 if quiet else cur + most
        out.append((cur, min(cut, duration)))
        cur = cut
    return out


def recording(r):
    """(duration, silences, labels): quarters of seconds, so that ends meet; silences are what nobody fills."""
    t, labels = 0.0, []
    for _ in range(r.randrange(25)):
        t += r.choice([0, 0.25, 1, 3, 14, 45]) * r.choice([-0.1, 1, 1])
        start = max(round(4 * t) / 4, 0.0)
        end = start + r.choice([0.25, 2, 6, 18, 40])
        labels.append((start, end, r.choice("abc")))
        t = end
    edges, silences = 0.0, []
    for s, e, _ in sorted(labels):
        if s > edges:
            silences.append((edges, s))
        edges = max(edges, e)
    if r.random() < 0.5:
        silences += [(a + 0.25, a + 0.75) for a in range(0, int(edges), 7)]
    return edges + r.choice([0, 5, 70]), sorted(silences), sorted(set(labels))


def test_fold_equals_its_restatement():
    r = random.Random(4)
    for _ in range(400):
        duration, silences, labels = recording(r)
        assert SG.fold(0.0, duration, True, silences, labels, SG.Rules())[0] == restated(duration, silences, labels)


def test_overlaps_are_skipped_and_speakers_are_cut(spark):
    span = "video string, start double, end double"
    quiet = spark.createDataFrame([("v", 60.0, 72.0), ("v", 12.0, 14.0), ("v", 12.0, 14.0), ("w", 3.0, 3.0), (None, 1.0, 2.0)], span)
    heard = spark.createDataFrame(
        [("v", 0.0, 12.0, "a"), ("v", 14.0, 32.0, "a"), ("v", 30.0, 41.0, "b"), ("v", 41.0, 60.0, "a"), ("v", 72.0, 80.0, None), ("x", 0.0, 5.0, "a")], f"{span}, label string")
    ends = spark.createDataFrame([("v", 80.0), ("w", 25.0), ("n", None), ("z", 0.0)], "video string, duration double")
    got = sorted(tuple(x) for x in SG.segment(quiet, ends, heard).collect())
    assert [g[2:] for g in got if g[0] == "v"] == [(0.0, 13.0), (32.0 + SG.BEHIND, 41.0), (41.0, 60.5), (72.0, 80.0)]
    assert [g[1:] for g in got if g[0] == "w"] == [(0, 0.0, 20.0), (1, 20.0, 25.0)] and {g[0] for g in got} == {"v", "w"}
    assert SG.segment(quiet.limit(0), ends.limit(0), heard.limit(0)).collect() == []


def test_stream_equals_batch(spark, tmp_path):
    r = random.Random(9)
    videos = {f"v{k}": recording(r) for k in range(6)}
    rows = [(v, s, e, None) for v, (_, q, _) in videos.items() for s, e in q] + [(v, *x) for v, (_, _, h) in videos.items() for x in h]
    schema = "video string, start double, end double, label string"
    edges = [0, 15, 40, 90, 1e9]
    for k in range(4):
        some = [x for x in rows if edges[k] <= x[1] < edges[k + 1]] + ([(v, None, d[0], None) for v, d in videos.items()] if k == 3 else [])
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        got = []
        q = segments.segment_stream(src).writeStream.foreachBatch(lambda d, _: got.extend(d.collect())).trigger(availableNow=True)
        q.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    for v, (duration, silences, labels) in videos.items():
        assert [(x.start, x.end) for x in sorted((x for x in got if x.video == v), key=lambda x: x.seg_idx)] == restated(duration, silences, labels)
