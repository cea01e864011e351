"""Operators against plain restatements, on the smallest tables."""

import collections
import hashlib
import math
import random
import re
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stenoflow.llm import common, decontaminate, graph, html_text, jaccard_join, mixing, secrets, token_counts, topk_search

from .conftest import DATA

BASE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), lambda m: len(m[2]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def base_spans(text):
    found = [(m.start(), i, m.end(), k) for i, (k, (p, ok)) in enumerate(BASE.items()) for m in p.finditer(text) if ok(m)]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def entropy_spans(text):
    """Windows of 20 characters recounted from the start each time."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text, re.A):
        word = m[0]
        if not re.search(r"[0-9][+/_=-]{0,19}[A-Za-z]|[A-Za-z][+/_=-]{0,19}[0-9]", word) or any(re.search(p, word) for p in secrets.ALLOW):
            continue
        bits = secrets.HEX_BITS if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", word) else secrets.MIXED_BITS
        spans = []
        for i in range(len(word) - 19):
            n = collections.Counter(word[i : i + 20])
            if -sum(c / 20 * math.log2(c / 20) for c in n.values()) >= bits - 1e-9:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 20
                else:
                    spans.append([i, i + 20])
        out += [f"entropy:{m.start() + a}:{m.start() + b}" for a, b in spans]
    return out


def test_secrets(spark, docs):
    r = random.Random(1)
    keys = ["password", "Token", "API_KEY", "apikey", "secret", "AKIA", "x", " ", "=", ":", '"', "'", "é", "😀", "0123456789abcdef", "deadbeef", "A1b2C3d4E5f6G7h8I9j0K1", "f00dfeed", "Zz9", "/", "-", "."]
    rows = [(i, "".join(r.choice(keys) for _ in range(r.randint(0, 25)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text"))
    for x in secrets.scan(df).collect():
        got = [f"{s['kind']}:{s['start']}:{s['end']}" for s in x["secrets"]]
        assert [s for s in got if not s.startswith("entropy")] == base_spans(x["text"])
        assert [s for s in got if s.startswith("entropy")] == entropy_spans(x["text"])


def test_secrets_query_and_mask(spark, docs):
    got = {r["doc_id"]: r for r in secrets.op1_secrets(spark, DATA).collect()}
    for r in docs.collect():
        base = base_spans(r["text"] or "")
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[r["doc_id"]][f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in base) for k in BASE]
    df = spark.createDataFrame([("a token = abcdefgh1 b", 1), ("none", 2)], "text string, i int")
    s = secrets.scan(df).select(secrets.redact(F.col("text"), F.col("secrets")).alias("t")).collect()
    assert [x["t"] for x in s] == ["a [secret] b", "none"]


def test_long_texts_cost_their_length(spark):
    r = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [
        "".join(r.choice(letters) for _ in range(200_000)), " ".join(f"token = k{i:07d}x" for i in range(20_000)),
        "é" + "".join(r.choice("aB1") for _ in range(5_000)) + "".join(r.choice(letters) for _ in range(300)) + " end",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    begun = time.monotonic()
    got = secrets.scan(df).withColumn("m", secrets.redact(F.col("text"), F.col("secrets"))).orderBy("i").collect()
    assert time.monotonic() - begun < 60
    for x in got:
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in x["secrets"] if s["kind"] != "entropy"] == base_spans(x["text"])
        assert [f"entropy:{s['start']}:{s['end']}" for s in x["secrets"] if s["kind"] == "entropy"] == entropy_spans(x["text"])
        masked, at = [], 0
        for s in x["secrets"]:
            masked += [x["text"][at : s["start"]], "[secret]"] if s["start"] >= at else []
            at = max(at, s["end"])
        assert x["m"] == "".join(masked) + x["text"][at:]


def test_long_candidates_are_measured_in_proportion(spark):
    """A base64 string of 200,000 characters and 20,000 assignments, as the query scans them."""
    r = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["".join(r.choice(letters) for _ in range(200_000)), " ".join(f'token = "{"".join(r.choice(letters[:-2]) for _ in range(20))}"' for _ in range(20_000))]
    begun = time.monotonic()
    long, many = spark.createDataFrame(list(enumerate(texts)), "i int, text string").transform(secrets.scan, fragments=True).orderBy("i").collect()
    assert time.monotonic() - begun < 60
    assert sum(s["end"] - s["start"] for s in long["secrets"]) > 199_000
    assert sum(s["kind"] == "assign" for s in many["secrets"]) == 20_000 and sum(s["kind"] == "entropy" for s in many["secrets"]) > 15_000


def infix(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_decontamination(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(r.randint(8, 20)))) for i in range(6)]
    rows = []
    for i in range(40):
        t = [word() for _ in range(r.randint(0, 40))]
        if i % 2:
            p = list(r.choice(items)[1])
            for _ in range(r.randint(0, 6)):
                p[r.randrange(len(p))] = r.choice("abcdefxyz")
            t.insert(r.randint(0, len(t)), "".join(p).upper() + "!!")
        rows.append((i, " ".join(t)))
    got = decontaminate.find(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for x in got.collect():
        body = decontaminate.normalise(x["text"])
        want = {}
        for i, t in items:
            item = decontaminate.normalise(t)
            d = infix(item, body)
            if d <= int(len(item) * decontaminate.EDIT_RATE):
                want[i] = d
        assert {c["item"]: c["distance"] for c in x["contamination"]} == want
        for c in x["contamination"]:
            assert infix(decontaminate.normalise(dict(items)[c["item"]]), body[c["start"] : c["end"]]) == c["distance"]


def test_decontamination_in_blocks(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    whole = decontaminate.find(docs, bench).orderBy("doc_id").select("doc_id", "contamination").collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2_000)
    assert decontaminate.find(docs, bench).orderBy("doc_id").select("doc_id", "contamination").collect() == whole


def waterfill(sizes, weights, total):
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    left = float(total)
    while open_ and left > 1e-9:
        w = sum(weights[s] for s in open_)
        add = {s: left * weights[s] / w for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += add[s]
            if target[s] >= 3 * sizes[s] - 1e-9:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("share", [1, 30])
def test_mixing(spark, share):
    r = random.Random(share)
    rows = [(i, "w " * r.randint(0, 30), None if i % 17 == 0 else f"s{min(r.randrange(12), r.randrange(share) + 3)}") for i in range(700)]
    got = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    want = waterfill(sizes, weights, sum(sizes.values()))
    taken = collections.Counter()
    for x in got:
        assert x["target"] == pytest.approx(want[x["source"]], abs=1e-3) and x["source_size"] == sizes[x["source"]]
        assert x["taken"] <= 3 * x["size"] and len(x["positions"]) == x["passes"]
        assert all(0 <= p <= 1 for p in x["positions"]) and x["positions"] == sorted(x["positions"])
        taken[x["source"]] += x["taken"]
    assert all(abs(taken[s] - want[s]) <= 30 for s in sizes)


def test_schedule_is_inverted(spark):
    knots = mixing._knots(F.col("rank"))
    df = spark.createDataFrame([(k, q / 20) for k in (1, 2, 3) for q in range(21)], "rank int, q double")
    for r in df.select("rank", "q", mixing.progress_at(mixing._segments(knots), F.col("q")).alias("u")).collect():
        pts, due = mixing.SCHEDULES[r["rank"] - 1], 0.0
        for (a, w), (b, v) in zip(pts, pts[1:], strict=False):
            x = min(max(r["u"] - a, 0), b - a)
            due += w * x + (v - w) / (b - a) * x * x / 2
        assert due == pytest.approx(r["q"], abs=1e-9)


def test_mix_rows(spark, docs):
    plan = {r["key"]: r["passes"] for r in mixing.plan(docs).collect()}
    got = mixing.mix(docs).collect()
    assert collections.Counter(r["doc_id"] for r in got) == {k: n for k, n in plan.items() if n}
    assert [r["position"] for r in got] == sorted(r["position"] for r in got)


def test_token_counts_equal_the_library(spark, docs):
    import public_tokenizers
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    for r in token_counts.op5_token_counts(spark, DATA).join(docs.select("doc_id", "text"), "doc_id").collect():
        text = r["text"] or ""
        assert (r["n_tokens"], r["n_bytes"]) == (len(library.encode(text)), len(text.encode()))
    r, machine = random.Random(4), token_counts.transducer(file)
    bits = ["a", "the", "in", "g", " ", "  ", "▁", "\n", "é", "ß", "<s>", "</s>", "<unk>", "<0x41>", "日", "😀", "1", "23", "!!", "####", "\r\n", "\x00", "ſ"]
    for size, run_up in ((1 << 14, 96), (1, 96), (2, 1), (5, 3), (7, 0)):
        token_counts.CHUNK, token_counts.WARM_UP = size, run_up
        for _ in range(1200):
            text = "".join(r.choice(bits) for _ in range(r.randint(0, 40)))
            assert machine.count(text) == len(library.encode(text)), repr(text)
        for letters in ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "aab", "的一是不了人我在", "thein"):
            text = "".join(r.choice(letters) for _ in range(700))
            assert machine.count(text) == len(library.encode(text)), letters
    token_counts.CHUNK, token_counts.WARM_UP = 1 << 14, 96
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(100_000))
    assert machine.count(text) == len(library.encode(text))


def test_search(spark, docs):
    got = collections.defaultdict(list)
    for r in topk_search.op6_topk_search(spark, DATA).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((round(r["score"], 6), r["doc_id"]))
    split = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tf = {r["doc_id"]: collections.Counter(split.findall((r["text"] or "").translate(lower))) for r in docs.collect()}
    df = collections.Counter(w for c in tf.values() for w in c)
    n, mean = len(tf), sum(sum(c.values()) for c in tf.values()) / len(tf)
    for q in (i for i in tf if i % 50 == 0):
        score = {}
        for i, c in tf.items():
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w in tf[q] if w in c)
            if s > 0:
                score[i] = round(s, 9)
        want = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:10]
        assert [s for s, _ in got[q]] == pytest.approx([s for _, s in want], abs=1e-5)
        assert [d for _, d in got[q]] == [d for d, _ in want]


def test_search_of_shards_segments_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SAMPLE_LEAST", 40)
    monkeypatch.setattr(topk_search, "BLOCK", 4)
    monkeypatch.setattr(topk_search, "QUERY_POSTINGS", 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    try:
        r = random.Random(9)
        rows = [(i, " ".join(f"w{int(r.paretovariate(0.7)) % 50}" for _ in range(r.randint(0, 25)))) for i in range(600)]
        rows += [(1000 + i, "w1 w2 w3 tie") for i in range(120)] + [(1050, "w1 w2 w3 tie"), (None, "w1 w2 w3 tie"), (2000, None)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        asked = df.where("doc_id % 37 = 0 or doc_id is null or doc_id = 1050")
        got = collections.defaultdict(list)
        for x in topk_search.search(df, asked).collect():
            got[x["query"]].append((x["rank"], x["found"], round(x["score"], 8)))
        tf = [(i, collections.Counter((t or "").split())) for i, t in rows]
        df_ = collections.Counter(w for _, c in tf for w in c)
        n, mean = len(tf), sum(sum(c.values()) for _, c in tf) / len(tf)
        want = collections.defaultdict(list)
        for q, terms in tf:
            if not (q is None or q % 37 == 0 or q == 1050):
                continue
            score = []
            for i, c in tf:
                norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
                s = sum(math.log(1 + (n - df_[w] + 0.5) / (df_[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w in terms if w in c)
                score += [(-round(s, 9), i is None, i)] if s > 0 else []
            want[q] += [(k, i, round(-s, 8)) for k, (s, _, i) in enumerate(sorted(score)[:10], 1)]
        assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items() if v}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def jaccard_components(rows):
    split, lower = re.compile(r"[^\x20\x09-\x0d]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = split.findall((t or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_join(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.op8_jaccard_join(spark, DATA).collect()}
    assert got == jaccard_components(rows)


@pytest.mark.parametrize("hot", [10_000, 4])
def test_jaccard_join_of_chains_and_hot_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "_HELD", 7)
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", hot)
    if hot < 10_000:
        monkeypatch.setattr(common, "within_bytes", lambda *_: False)
        monkeypatch.setattr(jaccard_join, "REMEMBERED", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        r, rows = random.Random(6), []
        for base in range(4):
            words = [f"w{r.randrange(60)}" for _ in range(70)]
            for k in range(25):
                w = list(words)
                for _ in range(r.randint(0, 4)):
                    w[r.randrange(len(w))] = f"u{r.randrange(9)}"
                if k % 5 == 0:
                    words = w
                rows.append((len(rows), " ".join(w[: r.choice([70, 70, 66, 60])])))
        rows += [(len(rows) + i, "a b c d e") for i in range(30)] + [(1000, "a b"), (1001, "A  B\n"), (1002, "")]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {x["key"]: (x["n_shingles"], x["component"]) for x in jaccard_join.components(df).collect()}
        assert got == jaccard_components(rows)
        kept = {x["doc_id"] for x in jaccard_join.keep_one(df).collect()}
        assert kept == {c for _, c in got.values()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_connected_components(spark):
    r = random.Random(7)
    links = [(i, i + 1) for i in range(40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(25)] + [(500, None), (7, 7)]
    got = {x["node"]: x["component"] for x in graph.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root}


def test_html_of_pages(spark):
    page = re.compile(r"<article>(.*)</article>", re.S)
    import html

    for r in html_text.op9_html_text(spark, DATA).join(spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.sub(r"<!--.*?-->", "", page.search(r["html"])[1], flags=re.S)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br[^>]*>", " ", x))).split()) for x in re.split(r"</?(?:p|h\d|li|ul|div)\b[^>]*>", body)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
        ("<body><nav>Home About</nav><main><h1>T</h1><p>One  two<br>three &lt;b&gt;</p><p>Four <i>five</i>.</p></main><footer>c</footer></body>", "T\nOne two three <b>\nFour five."),
        ("<div id=menu><a href=x>a</a><a href=y>b</a></div><div class='post'><p>First paragraph of the story.</p><p>Second paragraph.</p></div><div class=\"comments\"><p>A reader says a long thing about it all.</p></div>",
         "First paragraph of the story.\nSecond paragraph."),
        ("<article><p>Body text that is long enough.</p><form>Name <input></form><script>var a='</p>'</script><aside>Ad</aside><p>End.</p></article>", "Body text that is long enough.\nEnd."),
    ],
)
def test_html_shapes(page, text):
    assert html_text.extract(page) == text


def test_html_of_deep_and_broken_pages():
    assert html_text.extract("<div>" * 5000 + "deep text" + "</div>" * 10) == "deep text"
    assert html_text.extract("<p>a<p>b</i></div><li>c<li>d<!-- open") == "a\nb\nc\nd"


def test_mixing_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, size, source_size, target, taken, passes FROM ({mixing.OP4_SQL})").fetchall()}
    for r in mixing.op4_mixing(spark, DATA).collect():
        assert (r["size"], r["source_size"], pytest.approx(r["target"], abs=1e-5), r["taken"], r["passes"]) == want[r["doc_id"]]


def test_one_of_each_component_stays_under_repeated_keys(spark):
    a, b, c = "a b c d e f g h i j", "k l m n o p q r s t", "u v w x y z 1 2 3 4"
    rows = [(1, a), (1, a), (1, b), (2, a), (3, b), (4, c), (None, c), (None, "5 6 7 8 9 10"), (5, ""), (5, None)]
    got = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(str, [(1, a), (1, b), (4, c), (None, "5 6 7 8 9 10"), (5, ""), (5, None)]))


BODY = "<p>Body text that is long enough to be kept.</p>"
KEPT = "Body text that is long enough to be kept."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><div><svg class='i'/>{BODY}<p>More of it.</p></div></body>", f"{KEPT}\nMore of it."),
        (f"<body><div><math/>{BODY}</div><svg><path d='x'/><text>no</text></svg></body>", KEPT),
        (f"<body><div><svg><g><path d='x'/>{BODY}</div><svg></svg></body>", KEPT),
        (f"<body><div><svg><svg><text>a</text></svg><text>b</text></svg>{BODY}</div></body>", KEPT),
        (f"<body><div><select><option>a<option>b{BODY}</div></body>", KEPT),
        (f"<body><div><noscript>{BODY}</div></body>", KEPT),
        (f"<body><div><noscript>Off</noscript>{BODY}</div></body>", KEPT),
        (f"<body><main class='content has-sidebar'>{BODY}</main></body>", KEPT),
        (f"<body><article class='no-comments'>{BODY}</article></body>", KEPT),
        (f"<body><main id='related'>{BODY}</main></body>", KEPT),
        (f"<body><div class='elementor-widget'>{BODY}</div></body>", KEPT),
        (f"<body><div title='a hidden gem'>{BODY}</div></body>", KEPT),
        (f"<body><div>{BODY}<div hidden>No.</div><div class='x site-menu'>No.</div><div style='display: none'>No.</div></div></body>", KEPT),
    ],
)
def test_html_keeps_what_no_mark_takes(page, text):
    assert html_text.extract(page) == text


def test_allowed_words_hide_no_secret_beside_them(spark):
    import corpus_pipeline

    key, letters = "q7Zp2Lx9Vb4Nc8Tr1Wm6Kd3Hs5", "qWxZvBkPjYmGtRhNcLdFsUaE"
    found = {
        f"see bucket/example-prod/{key} now": key, f"for=your-app-{key}": key, f"{'A' * 12}/{key}": key,
        f"a {letters} b": letters, f"your_key/{letters}": letters,
    }
    none = [
        "123e4567-e89b-12d3-a456-426614174000", "placeholder-your-example", "0123456789abcdef0123456789", "A" * 60,
        "the-quick-brown-fox-jumps-over-the-lazy-dog", "Donaudampfschifffahrtsgesellschaft", "getElementsByClassName",
    ]
    df = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate([*found, *none])], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["text"]: r["s"] for r in secrets.scan(df, to="s", fragments=True).select("text", "s").collect()}
    for text, secret in found.items():
        a = text.index(secret)
        assert any(s["start"] <= a + 4 and s["end"] >= a + len(secret) - 4 for s in got[text]), text
    assert not any(got[text] for text in none)
    masked = {r["doc_id"]: r["text"] for r in corpus_pipeline.stage_secret_scan(spark, df, DATA).collect()}
    assert all(secret[4:-4] not in masked[i] for i, secret in enumerate(found.values()))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p title='the hidden truth'>Shown text.</p>", "Shown text."),
        ("<body><p>First <a href=x title=don't>link</a> text.</p><p>Second 'part' of it.</p></body>", "First link text.\nSecond 'part' of it."),
        ("<body><p>Look at <a class='share-price'>the share price</a> of <span class=share>it</span> now.</p></body>", "Look at the share price of it now."),
        ("<body><header>Site</header><article><header><h1>Title</h1></header><p>Body text of some length.</p></article></body>", "Title\nBody text of some length."),
        ("<body><div><p>Mass is <math><mi>m</mi><annotation>m_0</annotation></math> here, in short.</p></div></body>", "Mass is m here, in short."),
        (
            "<body><ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>Sports</a></ul><p>The first paragraph of the story is here, with words.</p>"
            "<p>The second one has <a href=4>a link</a> and more words to read.</p><ul><li><a href=5>Older story</a><li><a href=6>Other story</a></ul><p>Copyright 2020 Someone</p></body>",
            "The first paragraph of the story is here, with words.\nThe second one has a link and more words to read.",
        ),
        (
            "<body><div><div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><div><div>Plain text of a page without any names, long enough.</div>"
            "<div>Another block of it.</div></div><div><a href=4>Imprint</a> <a href=5>Privacy</a></div></div></body>",
            "Plain text of a page without any names, long enough.\nAnother block of it.",
        ),
    ],
)
def test_html_without_names(page, text):
    assert html_text.extract(page) == text


def test_html_of_stray_end_tags_costs_its_length():
    begun = time.monotonic()
    assert html_text.extract("<div>" * 20_000 + "deep text" + "</i></section>" * 20_000) == "deep text"
    assert time.monotonic() - begun < 5


@pytest.mark.parametrize("k", [1, 3, 10])
def test_search_skips_blocks_and_loses_none(monkeypatch, k):
    monkeypatch.setattr(topk_search, "BLOCK", 8)
    r = random.Random(k)
    # ten subjects with words of their own, common words and copies
    texts = [" ".join([f"s{i % 10}x{int(r.paretovariate(0.8)) % 40}" for _ in range(20)] + [f"c{r.randrange(6)}" for _ in range(6)]) for i in range(1500)]
    texts += [texts[3]] * 40 + ["", "c1"]
    buf, offsets = topk_search.B.utf8(pa.array(texts))
    h, bounds = topk_search.terms_of(buf, offsets)
    sets = [np.unique(h[bounds[i] : bounds[i + 1]]) for i in range(0, len(texts), 60)] + [np.zeros(0, np.uint64), np.array([7], np.uint64)]
    queries = topk_search.Queries(sets)
    places = topk_search.Places(queries.terms)
    doc, term, tf, length = topk_search.postings(buf, offsets, places)
    df = np.bincount(term, minlength=len(queries.terms))
    idf = np.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
    segment = topk_search.Segment(buf, offsets, places, idf, length.mean())
    asked = [queries.of(q) for q in range(len(queries))]
    rank = np.arange(len(texts))
    found = list(segment.search(asked, k, np.zeros(len(asked)), rank))
    impact = idf[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length[doc] / length.mean()))
    all_postings = 0
    for terms, got in zip(asked, found, strict=True):
        inside = np.isin(term, terms)
        all_postings += int(inside.sum())
        score = np.round(np.bincount(doc[inside], impact[inside], minlength=len(texts)), 9)
        order = [int(d) for d in np.lexsort((rank, -score))[:k] if score[d] > 0]
        assert [d for _, d in got] == order
        assert [s for s, _ in got] == pytest.approx(score[order].tolist())
    pairs = len(asked) * segment.n_blocks
    work = dict(segment.work)
    assert work["scored"] <= work["read"] <= work["pivots"] < 0.9 * pairs and work["scored"] < 0.5 * pairs
    # with the final thresholds the same rows come out, and less is read
    least = np.array([hits[-1][0] if len(hits) == k else 0 for hits in found])
    assert list(segment.search(asked, k, least, rank)) == found
    assert all(segment.work[x] - work[x] <= work[x] for x in work) and segment.work["scored"] - work["scored"] < work["scored"]
    assert work["postings"] < all_postings


def test_cursors_move_to_the_first_entry_behind():
    texts = [f"all {'even' if i % 2 == 0 else 'odd'} {'last' if i == 9 else ''}" for i in range(10)]
    buf, offsets = topk_search.B.utf8(pa.array(texts))
    places = topk_search.Places(np.unique(topk_search.terms_of(buf, offsets)[0]))
    segment = topk_search.Segment(buf, offsets, places, np.ones(4), 2.0)
    lists = {t: set() for t in range(4)}
    for e in segment.entry:
        lists[int(e) // segment.n_blocks].add(int(e) % segment.n_blocks)
    cursors = topk_search.Cursors(segment, np.arange(4))
    for to in range(segment.n_blocks + 1):
        cursors.to(to)
        for t in range(4):
            assert cursors.block(np.array([t]))[0] == min((b for b in lists[t] if b >= to), default=segment.n_blocks)


def test_terms_are_found_by_their_first_bits():
    r = np.random.default_rng(5)
    # some terms share their first bits, the first and the last ones among them
    terms = np.unique(np.concatenate([r.integers(0, 1 << 64, 500, dtype=np.uint64), np.arange(9, dtype=np.uint64), np.uint64((1 << 64) - 1) - np.arange(9, dtype=np.uint64)]))
    words = np.concatenate([r.choice(terms, 2_000), r.integers(0, 1 << 64, 500, dtype=np.uint64), terms + np.uint64(1)])
    at, place = topk_search.Places(terms)(words)
    inside = np.isin(words, terms)
    assert at.tolist() == np.flatnonzero(inside).tolist() and (terms[place] == words[inside]).all()
    assert [len(x) for x in topk_search.Places(terms[:0])(words)] == [0, 0]


def test_search_counts_terms_once_for_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_POSTINGS", 12)
    rows = [(i, " ".join(f"w{(i * k) % 41}" for k in range(1, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    queries = df.where("doc_id % 20 = 0")
    passes, count = [], topk_search.Counts._add
    monkeypatch.setattr(topk_search.Counts, "_add", lambda self, docs, terms: passes.append(len(terms)) or count(self, docs, terms))
    got = sorted(map(tuple, topk_search.search(df, queries).collect()))
    assert len(passes) == 1
    monkeypatch.setattr(topk_search, "COUNTED_TERMS", 5)
    assert sorted(map(tuple, topk_search.search(df, queries).collect())) == got and len(passes) > 3
    monkeypatch.setattr(topk_search, "QUERY_POSTINGS", 1_000_000)
    assert sorted(map(tuple, topk_search.search(df, queries).collect())) == got
