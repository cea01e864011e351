"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's log-odds are a bias plus the weights of
the offending features among its words (the lower-cased word and its leading 4 to 7
bytes, which stand for stems); the document's probability is the noisy-or of its
sentences, so one offending sentence is enough.  Only document labels are learned from:
the gradient of the document's likelihood gives every sentence its share of the blame,
and sentences at or above `SENTENCE_THRESHOLD` are then located as offending.  Weights
are kept at or above zero, since words can only add evidence.

Training has three steps on a bounded sample of labelled rows, whose vocabulary bounds all
that follows: features that several toxic texts share (aggregated by Spark), their counts in
clean texts (which leaves those with a lift), and the fit of the noisy-or on the driver, which
receives only sentence numbers of lifted features.

Defined cases: null and empty texts have no sentence and score 0.  A text without
sentence marks is one sentence.  Texts of any length are read whole.  Rows whose label
is null or not 0/1 are not learned from; without labelled rows every score is 0.
Columns named like the results are replaced by them; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.llm import bytesets as B
from stenoflow.llm import common as C

#: Rows of either label learned from, at most: the documented bound of the training sample.
SAMPLE_ROWS = 6_000
#: Toxic texts of the sample that a feature needs: this, or a share of them where they are few.
MIN_DOCUMENTS, MIN_SHARE = 5, 0.1
#: How much more often than in clean texts a feature must stand in toxic ones.
LEAST_LIFT = 4.0
#: Scores from here up predict label 1.
THRESHOLD = 0.7
SENTENCE_THRESHOLD = 0.5

_WORD = B.byte_table(True, B.ALNUM)
_MARK = B.byte_set(b".!?\n")
_STEMS = (4, 5, 6, 7)
_WIDTH = 1 + len(_STEMS)


def word_features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashes of each word and of its stems; a word no longer than a stem has no such stem."""
    out = np.zeros((len(h), _WIDTH), np.uint64)
    out[:, 0] = h
    value, k = np.zeros(len(h), np.uint64), 0
    for col, size in enumerate(_STEMS, 1):
        while k < size:
            at = np.minimum(starts + k, ends - 1)
            value = (value ^ _WORD[buf[at]]) * np.uint64(0x9E3779B97F4A7C15)
            k += 1
        out[:, col] = np.where(ends - starts > size, B.mix64(value + np.uint64(size)), np.uint64(0))
    return out


def sentences(
    buf: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word features, sentence of each word, and per sentence: text, first byte, last byte.

    Sentences end at full stops, exclamation and question marks and line ends, and hold
    one word at least.
    """
    starts, ends, h = B.words(buf, offsets, B.ALNUM, _WORD)
    if not len(h):
        none = np.zeros(0, np.int64)
        return np.zeros((0, _WIDTH), np.uint64), none, none, none, none
    mark = np.cumsum(_MARK[buf])[starts]
    row = np.searchsorted(offsets, starts, "right") - 1
    new = np.ones(len(h), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(h)) - 1
    return word_features(buf, starts, ends, h), np.cumsum(new) - 1, row[at], starts[at], ends[last]


class Lookup:
    """Position of 64-bit hashes in a sorted array, -1 for those that it lacks."""

    def __init__(self, known: np.ndarray):
        self.known = np.sort(known.astype(np.uint64))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known >> np.uint64(44)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat positions in h that are known, and their places in the known array."""
        flat = h.ravel()
        at = np.flatnonzero(self.maybe[(flat >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.known):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.known, flat[at]), len(self.known) - 1)
        ok = self.known[place] == flat[at]
        return at[ok], place[ok]


def noisy_or(p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    safe = np.log1p(-np.minimum(p, 1 - 1e-12))
    return 1 - np.exp(np.bincount(row, safe, minlength=n))


@dataclass
class Model:
    lookup: Lookup
    weights: np.ndarray
    bias: float

    def sentence_scores(self, ids: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        at, place = self.lookup(ids)
        total = np.bincount(sentence[at // _WIDTH], self.weights[place], minlength=n)
        return 1 / (1 + np.exp(-np.clip(self.bias + total, -35, 35)))


def fit(
    bags: list[tuple[int, np.ndarray, np.ndarray, int]],
    n_features: int,
    *,
    rounds: int = 300,
    rate: float = 0.15,
    l1: float = 3e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias from (sentences, feature of hit, sentence of hit, label) bags.

    Adam with non-negative soft thresholding on the noisy-or likelihood.
    """
    if not bags:
        return np.zeros(n_features), -35.0
    base = np.cumsum([0] + [b[0] for b in bags])
    word = np.concatenate([b[1] for b in bags]).astype(np.int64)
    sent = np.concatenate([b[2] + base[k] for k, b in enumerate(bags)]).astype(np.int64)
    row = np.repeat(np.arange(len(bags)), np.diff(base))
    y = np.array([b[3] for b in bags], float)
    n, total = len(bags), int(base[-1])
    w, b = np.full(n_features, 0.5), -9.0
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for t in range(1, rounds + 1):
        s = b + np.bincount(sent, w[word], minlength=total)
        p = 1 / (1 + np.exp(-np.clip(s, -35, 35)))
        doc = np.clip(noisy_or(p, row, n), 1e-9, 1 - 1e-9)
        # d loss / d s: p for a clean document, -p (1 - P) / P for a toxic one
        gs = p * np.where(y > 0, -(1 - doc) / doc, 1.0)[row] / n
        g, gb = np.bincount(word, gs[sent], minlength=n_features) + l1, gs.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.99**t
        step = rate / (1 + t / 100)
        w = np.maximum(0, w - step * (m / c1) / (np.sqrt(v / c2) + 1e-7))
        b = b - step * (mb / c1) / (np.sqrt(vb / c2) + 1e-7)
    return w, float(b)


def _per_text(batches: Iterator[pa.RecordBatch]):
    """(label, features, sentence, number of sentences) of every text of the batches."""
    for batch in batches:
        labels = batch.column("label").to_pylist()
        buf, offsets = B.utf8(batch.column("text"))
        for i, label in enumerate(labels):
            part = buf[offsets[i] : offsets[i + 1]]
            ids, sentence, row, _, _ = sentences(part, np.array([0, len(part)]))
            yield label, ids, sentence, len(row)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = [np.unique(ids) for _, ids, _, _ in _per_text(batches)]
    if found:
        h, count = np.unique(np.concatenate(found), return_counts=True)
        count = count[h != 0]
        h = h[h != 0]
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(count)], names=["h", "n"])


def train(
    df: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "label"
) -> Model:
    """Learn from at most about SAMPLE_ROWS rows of either label, 0 and 1, in the table of labels.

    The labels are drawn first, by a hash of the key, so that only a table of bounded size
    meets the texts; of the rows under drawn keys that many rows share, see common.drawn_rows.
    """
    C.ship(df.sparkSession)
    known = C.known_labels(labels, key, label)
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, SAMPLE_ROWS / max(1, n.get(1, 0))).otherwise(
        SAMPLE_ROWS / max(1, n.get(0, 0))
    )
    draw = C.unit_hash(F.col("k"), F.lit("toxicity"))
    drawn = known.withColumn("o", draw).where(F.col("o") < share)
    texts = df.where(F.col(f"`{text}`").isNotNull())
    sample = C.cut(C.drawn_rows(texts, drawn, 4 * SAMPLE_ROWS, key=key, text=text).select("label", "o", "text"))
    shared = (
        sample.where("label = 1").select("label", "text")
        .mapInArrow(_shared, "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min(MIN_DOCUMENTS, max(1, int(MIN_SHARE * n.get(1, 0)))))
        .collect()
    )
    candidates = Lookup(np.array([r["h"] for r in shared], np.int64).view(np.uint64))
    pos = dict(zip((r["h"] for r in shared), (r["n"] for r in shared), strict=True))
    toxic = np.array([pos[int(h)] for h in candidates.known.view(np.int64)], float)

    def clean_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates.known), np.int64)
        for _, ids, _, _ in _per_text(batches):
            total[np.unique(candidates(ids)[1])] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    clean = np.zeros(len(toxic))
    for r in (
        sample.where("label = 0").select("label", "text")
        .mapInArrow(clean_counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    ):
        clean[r["at"]] = r["n"]
    n_toxic, n_clean = min(n.get(1, 0), SAMPLE_ROWS) or 1, min(n.get(0, 0), SAMPLE_ROWS) or 1
    lift = (toxic / n_toxic) / ((clean + 0.5) / n_clean)
    kept = np.flatnonzero(lift >= LEAST_LIFT)
    lookup = Lookup(candidates.known[kept])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            order = batch.column("o").to_pylist()
            for o, (y, ids, sentence, count) in zip(order, _per_text([batch]), strict=True):
                at, place = lookup(ids)
                out.append({"o": o, "label": y, "n": count, "f": place.tolist(), "s": sentence[at // _WIDTH].tolist()})
        yield pa.RecordBatch.from_pylist(out, schema=_HITS)

    bags = [
        (r["n"], np.array(r["f"], np.int64), np.array(r["s"], np.int64), r["label"], r["o"])
        for r in sample.mapInArrow(hits, _HIT_DDL).toLocalIterator()
    ]
    bags.sort(key=lambda b: (b[4], b[3], b[0], b[1].tobytes(), b[2].tobytes()))
    weights, bias = fit([b[:4] for b in bags], len(lookup.known))
    return Model(lookup, weights, bias)


_HIT_DDL = "o double, label int, n long, f array<int>, s array<int>"
_HITS = pa.schema([("o", pa.float64()), ("label", pa.int32()), ("n", pa.int64()), ("f", pa.list_(pa.int32())), ("s", pa.list_(pa.int32()))])

_SPAN = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()).add("p", T.DoubleType())
_VALUE = T.StructType().add("p", T.DoubleType()).add("spans", T.ArrayType(_SPAN))


def score(
    df: DataFrame,
    model: Model,
    *,
    text: str = "text",
    to: tuple[str, str, str] = ("score", "predicted", "offending"),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """df with the noisy-or score, the prediction, and the offending sentences.

    `offending` lists (start, end, p) in code points of the text, ends exclusive, for every
    sentence at or above SENTENCE_THRESHOLD, in text order.
    """
    C.ship(df.sparkSession)
    name, predicted, offending = to

    @F.arrow_udf(_VALUE)
    def value(column: pa.Array) -> pa.Array:
        buf, offsets = B.utf8(column)
        docs, ends = [np.zeros(0)], [0]
        parts = []
        for i, j in B.slices(offsets):
            local = offsets[i : j + 1] - offsets[i]
            ids, sentence, row, start, end = sentences(buf[offsets[i] : offsets[j]], local)
            p = model.sentence_scores(ids, sentence, len(row))
            docs.append(noisy_or(p, row, j - i))
            bad = np.flatnonzero(p >= SENTENCE_THRESHOLD)
            # bytes to code points: those that continue a character do not count
            place = np.zeros(local[-1] + 1, np.int64)
            np.cumsum(buf[offsets[i] : offsets[j]] & 0xC0 != 0x80, out=place[1:])
            begin = place[local[row[bad]]]
            parts.append((place[start[bad]] - begin, place[end[bad]] - begin, p[bad]))
            ends += (ends[-1] + np.searchsorted(row[bad], np.arange(j - i), "right")).tolist()
        start, end, p = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else ([], [], [])
        spans = pa.StructArray.from_arrays(
            [pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(p, pa.float64())],
            names=["start", "end", "p"],
        )
        return pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(docs)),
                pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), spans),
            ],
            names=["p", "spans"],
        )

    tox, both = C.free_name(df, "__tox"), C.free_name(df, "__toxic")
    scored = df.withColumn(tox, value(F.col(f"`{text}`").cast("string"))).withColumn(
        both,
        F.struct(
            F.col(f"{tox}.p").alias(name),
            (F.col(f"{tox}.p") >= threshold).cast("int").alias(predicted),
            F.col(f"{tox}.spans").alias(offending),
        ),
    )
    return C.replace_columns(scored.drop(tox), both, list(to))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; documents whose fold is 1 are held out of training."""
    docs = C.table(spark, sf_dir, "documents")
    labels = C.table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = train(docs, labels.where(C.fold("doc_id", 3) != 1))
    held = (C.fold("doc_id", 3) == 1).alias("held_out")
    return score(docs.select("doc_id", held, "text"), model).drop("text")
