"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-proximal) updates.

A text is the bag of its word uni- and bigrams, taken twice: over the words as
written, and over their shapes (runs of upper case, lower case, digits and other
characters collapsed to one sign each, a word equal to its predecessor marked as
a repeat).  All features are hashed into one weight table; a text's value is the
sparse dot product of its relative feature frequencies with the table.

Training keeps FTRL's two accumulators per coordinate, reads a bounded sample of
labelled rows in a fixed order, and is therefore repeatable.

Defined cases: null and empty texts have no feature and score the model's
intercept.  Texts of any length are read whole.  Rows whose label is null or not
0/1 are not learned from.  Without labelled rows every score is 0.5.  Columns
named like the results are replaced by them; all other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.llm import bytesets as B
from stenoflow.llm import common as C

#: Rows learned from, about: the documented bound of the training sample, at most about twice as many where rows share keys.
SAMPLE_ROWS = 5_000
BITS = 18
#: Relative frequencies are multiplied by this before the dot product.
SCALE = 20.0
#: Scores from here up predict label 1.
THRESHOLD = 0.3

_NOT_BLANK = ~B.BLANKS
_WORD = B.byte_table(False, _NOT_BLANK)


def _shape_table() -> np.ndarray:
    kind = np.arange(256)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 2
    return kind


_KIND = _shape_table()
_SHAPE = B.mix64((_KIND + 1).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
_SHAPE[B.BLANKS] = 0


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of texts laid end to end, and each text's bounds in them.

    Every word has four entries: word, word bigram, shape, shape bigram.
    """
    starts, ends, h = B.words(buf, offsets, _NOT_BLANK, _WORD)
    bounds = B.row_bounds(starts, offsets)
    n = len(h)
    if not n:
        return np.zeros((0, 4), np.int32), bounds
    first = np.zeros(n, bool)
    first[bounds[:-1][bounds[:-1] < n]] = True
    before = np.roll(h, 1)
    before[first] = 1
    # the shape sums one value per run of a kind, weighted by the run's place in the word
    kind = _KIND[buf]
    run = np.ones(len(buf), bool)
    run[1:] = kind[1:] != kind[:-1]
    run[starts] = True
    order = np.cumsum(run)
    place = (order - np.repeat(order[starts], np.diff(np.append(starts, len(buf))))
             if starts[0] == 0 else None)
    if place is None:
        place = np.zeros(len(buf), np.int64)
        place[starts[0] :] = order[starts[0] :] - np.repeat(
            order[starts], np.diff(np.append(starts, len(buf)))
        )
    value = np.where(run, _SHAPE[buf] * (2 * np.minimum(place, 7) + 1).astype(np.uint64), np.uint64(0))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    shape = B.mix64(sums[ends] - sums[starts])
    shape[(h == before) & ~first] = 7
    shape_before = np.roll(shape, 1)
    shape_before[first] = 1
    grams = np.stack(
        [
            h,
            h * np.uint64(3) + before * np.uint64(0x9E3779B97F4A7C15),
            shape + np.uint64(0x51ED2701),
            shape * np.uint64(5) + shape_before * np.uint64(0xC2B2AE3D27D4EB4F),
        ],
        1,
    )
    return (B.mix64(grams) >> np.uint64(64 - BITS)).astype(np.int32), bounds


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        ids, bounds = features(buf, offsets)
        total = B.row_sums(self.weights[ids].sum(1), bounds)
        count = np.maximum(4 * np.diff(bounds), 1)
        return 1 / (1 + np.exp(-np.clip(self.bias + SCALE * total / count, -35, 35)))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    *,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.5,
    epochs: int = 6,
) -> Model:
    """FTRL-proximal over (feature ids, relative frequencies, label) rows, in order."""
    size = 1 << BITS
    z, s = np.zeros(size + 1), np.zeros(size + 1)

    def weight(i):
        zi = z[i]
        return np.where(
            np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(s[i])) / alpha + l2)
        )

    for _ in range(epochs if rows else 0):
        for ids, freq, label in rows:
            at = np.append(ids, size)
            x = np.append(freq * SCALE, 1.0)
            w = weight(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            sigma = (np.sqrt(s[at] + g * g) - np.sqrt(s[at])) / alpha
            z[at] += g - sigma * w
            s[at] += g * g
    all_w = weight(np.arange(size + 1))
    return Model(all_w[:size].astype(np.float32), float(all_w[size]))


@F.arrow_udf(T.BinaryType())
def _bag(text: pa.Array) -> pa.Array:
    """Feature ids (int32), then their relative frequencies (float32), of each text."""
    buf, offsets = B.utf8(text)
    out = []
    for i, j in B.slices(offsets):
        ids, bounds = features(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            found, count = np.unique(ids[a:b], return_counts=True)
            freq = (count / max(1, count.sum())).astype(np.float32)
            out.append(found.astype(np.int32).tobytes() + freq.tobytes())
    return pa.array(out, pa.binary())


def train(
    df: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "label"
) -> Model:
    """Learn from at most about SAMPLE_ROWS rows of df that have a label 0 or 1 in the table of labels.

    The labels are drawn first, by a hash of the key, so that only a table of bounded size
    meets the texts; of the rows under drawn keys that many rows share, see common.drawn_rows.
    """
    C.ship(df.sparkSession)
    known = C.known_labels(labels, key, label)
    order = C.unit_hash(F.col("k"), F.lit("quality"))
    drawn = known.withColumn("o", order).where(F.col("o") < SAMPLE_ROWS / max(known.count(), 1))
    rows = C.drawn_rows(df, drawn, 2 * SAMPLE_ROWS, key=key, text=text).select("label", "o", _bag("text").alias("bag"))
    got = []
    for r in rows.toLocalIterator():
        k = len(r["bag"]) // 8
        ids = np.frombuffer(r["bag"], np.int32, k)
        got.append((r["o"], ids, np.frombuffer(r["bag"], np.float32, k, 4 * k), r["label"]))
    got.sort(key=lambda r: (r[0], r[3], len(r[1]), r[1].tobytes()))
    return fit([r[1:] for r in got])


def score(
    df: DataFrame,
    model: Model,
    *,
    text: str = "text",
    to: tuple[str, str] = ("score", "predicted"),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """df with the probability of label 1 and the prediction at the threshold."""
    C.ship(df.sparkSession)
    name, predicted = to

    @F.arrow_udf("double")
    def value(column: pa.Array) -> pa.Array:
        buf, offsets = B.utf8(column)
        out = [
            model.score(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            for i, j in B.slices(offsets)
        ]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    p, both = C.free_name(df, "__p"), C.free_name(df, "__quality")
    scored = df.withColumn(p, value(F.col(f"`{text}`").cast("string"))).withColumn(
        both, F.struct(F.col(p).alias(name), (F.col(p) >= threshold).cast("int").alias(predicted))
    )
    return C.replace_columns(scored.drop(p), both, [name, predicted])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; documents whose fold is 0 are held out of training."""
    docs = C.table(spark, sf_dir, "documents")
    labels = C.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = train(docs, labels.where(C.fold("doc_id", 5) != 0))
    held = (C.fold("doc_id", 5) == 0).alias("held_out")
    return score(docs.select("doc_id", held, "text"), model).drop("text")
