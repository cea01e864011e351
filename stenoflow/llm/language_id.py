"""Language identification by hierarchical discrimination.

A first linear model predicts the language family; inside the family,
one-versus-one linear support vector machines vote between the related
languages.  Features are the relative frequencies of hashed byte n-grams (two
to four bytes) of the lower-cased whole text.  A linear model over relative
frequencies scores a text as the mean of one table entry per n-gram, so
prediction is a table lookup and a segmented sum.

The score compares the learned languages with each other, so it cannot tell that a text is
in none of them.  That is told by an absolute measure: the mean surprise of the n-grams of
letters (minus the log of their largest frequency in a learned language) against a limit
calibrated on rows that the frequencies were not taken from.  Numbers, keys and marks do
not count for it, but a text must have some share of letters.

Defined cases: a null text, or a text without a letter, is `und` with score 0.
Texts of any length are read whole.  Repeated rows get equal results.  With no
labelled row to learn from, every text is `und`.  Columns named like the
results are replaced by them; all other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.llm import bytesets as B
from stenoflow.llm import common as C

#: Rows learned from, per language, at most: the documented bound of the training sample.
SAMPLE_PER_LANGUAGE = 300
#: Rows learned from in all languages together, at most: with more languages each has fewer
#: rows, and no language is left out as long as there are not more languages than rows.
SAMPLE_ROWS = 6_000
#: Size of the hashed feature space.
DIMENSIONS = 1 << 12
#: Relative frequencies are small; margins are learned on this multiple of them.
SCALE = 100.0
#: A text is known up to so many times the surprise, beyond the mean, of all but this share
#: of the held-out rows, and at least up to LEAST_SURPRISE; short texts may have SHORT
#: standard errors more.
SURPRISE, STRAY, LEAST_SURPRISE, SHORT = 1.5, 0.005, 0.3, 4.0
#: Least share of letters in the bytes of a known text that are not blank.
LEAST_LETTERS = 0.1

#: Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca co es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu se",
    "celtic": "br cy ga gd gv kw",
    "hellenic": "el",
    "albanian": "sq",
    "armenian": "hy",
    "kartvelian": "ka",
    "basque": "eu",
    "turkic": "az kk ky tk tr tt ug uz",
    "iranian": "fa ku ps tg",
    "indic": "as bn gu hi mr ne or pa sd si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt ti",
    "sinitic": "yue zh",
    "japonic": "ja",
    "koreanic": "ko",
    "austronesian": "id jv mg mi ms su tl",
    "austroasiatic": "km vi",
    "tai": "lo th",
    "bantu": "rw sn sw xh zu",
}


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), f"other:{code}")


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] = np.arange(97, 123)


def _ngram_ids(buf: np.ndarray) -> np.ndarray:
    """Feature of the two-, three- and four-byte sequence that ends at each byte."""
    b = _LOWER[buf]
    n = len(b)
    last = np.zeros((4, n), np.uint32)
    for k in range(4):
        last[k, k:] = b[: n - k]
    out = np.empty((n, 3), np.int32)
    code = last[0] | (last[1] << np.uint32(8))
    for j in range(3):
        mixed = (code + np.uint32(j * 0x51ED27)) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        out[:, j] = (mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - 12)
        if j < 2:
            code = code * np.uint32(0x01000193) + last[j + 2]
    return out


def _features(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of texts laid end to end, and which of them lie within one text."""
    keep = np.ones((len(buf), 3), bool)
    for k in range(3):
        at = starts + k
        keep[at[at < len(buf)], k:] = False
    return _ngram_ids(buf), keep


def _chunks(buf: np.ndarray, offsets: np.ndarray):
    """(begin, end, features, kept) of consecutive parts; a cut changes no feature."""
    for at in range(0, len(buf), B.SLICE_BYTES // 4):
        lo, hi = max(0, at - 3), min(len(buf), at + B.SLICE_BYTES // 4)
        ids, keep = _features(buf[lo:hi], offsets[(offsets >= lo) & (offsets < hi)] - lo)
        yield at, hi, ids[at - lo :], keep[at - lo :]


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PLAIN = _LETTER | B.BLANKS


def _of_letters(buf: np.ndarray) -> np.ndarray:
    """Which n-grams that end at each byte are of letters and blanks, with a letter."""
    letter, plain = _LETTER[buf], _PLAIN[buf]
    out = np.zeros((len(buf), 3), bool)
    for k in range(1, 4):
        letter[k:] |= _LETTER[buf[:-k]]
        plain[k:] &= _PLAIN[buf[:-k]]
        out[:, k - 1] = letter & plain
    return out


@dataclass
class Model:
    languages: list[str]
    families: list[str]
    #: One column per family, then one per pair of languages of a family.
    weights: np.ndarray
    bias: np.ndarray
    pairs: list[tuple[int, int]]
    #: Surprise of each n-gram, its spread, and the most surprise of a known text.
    surprise: np.ndarray
    spread: float
    limit: float

    def known(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each text is in a learned language at all."""
        total, count, letters, shown = np.zeros((4, len(offsets) - 1))
        table = np.append(self.surprise, np.float32(0))
        for at, hi, ids, keep in _chunks(buf, offsets):
            bounds = np.clip(offsets - at, 0, hi - at)
            letters += B.row_sums(_LETTER[buf[at:hi]].astype(float), bounds)
            shown += B.row_sums((~B.BLANKS)[buf[at:hi]].astype(float), bounds)
            lo = max(0, at - 3)
            keep &= _of_letters(buf[lo:hi])[at - lo :]
            ids[~keep] = DIMENSIONS
            count += B.row_sums(keep.sum(1).astype(float), bounds)
            total += B.row_sums(table[ids].sum(1, dtype=float), bounds)
        n = np.maximum(count, 1)
        # a text without such an n-gram, like a single letter and a stop, is told by its letters alone
        return (letters >= LEAST_LETTERS * shown) & (total / n <= self.limit + SHORT * self.spread / np.sqrt(n))

    def margins(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n_rows, width = len(offsets) - 1, self.weights.shape[1]
        total, count = np.zeros((n_rows, width)), np.zeros(n_rows)
        # n-grams that are no features of one text find a row of zeros
        table = np.vstack([self.weights, np.zeros((1, width), np.float32)])
        for at, hi, ids, keep in _chunks(buf, offsets):
            bounds = np.clip(offsets - at, 0, hi - at)
            ids[~keep] = DIMENSIONS
            count += B.row_sums(keep.sum(1).astype(float), bounds)
            total += B.row_sums(table[ids[:, 0]] + table[ids[:, 1]] + table[ids[:, 2]], bounds)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and score of every text."""
        m = self.margins(buf, offsets)
        n, nf = len(m), len(self.families)
        top = np.exp(m[:, :nf] - m[:, :nf].max(1, keepdims=True))
        top /= top.sum(1, keepdims=True)
        family = top.argmax(1)
        votes = np.zeros((n, len(self.languages)))
        for k, (a, b) in enumerate(self.pairs):
            p = 1 / (1 + np.exp(-np.clip(m[:, nf + k], -30, 30)))
            votes[:, a] += p
            votes[:, b] += 1 - p
        home = np.array([self.families.index(family_of(x)) for x in self.languages])
        rivals = np.array([max(1, int((home == h).sum()) - 1) for h in home])
        alone = np.array([(home == h).sum() == 1 for h in home])
        within = np.where(alone, 1.0, votes / rivals)
        within = np.where(home[None, :] == family[:, None], within, -1.0)
        best = within.argmax(1)
        rows = np.arange(n)
        return best, np.clip(top[rows, family] * within[rows, best], 0, 1)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge loss) by averaged, accelerated gradient steps."""
    n, d = x.shape
    w, b = np.zeros(d, x.dtype), x.dtype.type(0)
    vw, vb = w.copy(), b
    y, weight = y.astype(x.dtype), weight.astype(x.dtype)
    lip = 2 * float((weight * (np.einsum("ij,ij->i", x, x) + 1)).sum())
    lam, step, t = x.dtype.type(1e-4), x.dtype.type(1.0 / (lip + 1e-4)), 1.0
    for _ in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ vw + vb))
        pull = -2 * weight * y * gap
        nw, nb = vw - step * (x.T @ pull + lam * vw), vb - step * pull.sum()
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def _balanced(y: np.ndarray) -> np.ndarray:
    share = np.where(y > 0, max(1, (y > 0).sum()), max(1, (y < 0).sum()))
    return 0.5 / share


def _surprise(x: np.ndarray, lab: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Surprise of each n-gram, and the mean and spread in the language that has most of either."""
    p = np.stack([x[lab == k].mean(0, dtype=np.float64) + 1e-6 for k in np.unique(lab)])
    p /= p.sum(1, keepdims=True)
    s = -np.log(p.max(0))
    mean = p @ s
    return s.astype(np.float32), float(mean.max()), float(np.maximum(p @ s**2 - mean**2, 0).max()) ** 0.5


def _calibrated(x: np.ndarray, counts: np.ndarray, lab: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Surprise of each n-gram, its spread and the most surprise of a known text."""
    some = counts > 0
    x, counts, lab = x[some], counts[some], lab[some]
    if not len(x):
        return np.zeros(DIMENSIONS, np.float32), 0.0, np.inf
    s, mean, spread = _surprise(x, lab)
    half = np.zeros(len(lab), int)
    for k in np.unique(lab):
        half[lab == k] = np.arange((lab == k).sum()) % 2
    beyond = []
    for h in (0, 1):
        # rows of a language that the other half has not are no measure
        held = (half == h) & np.isin(lab, lab[half != h])
        if held.any():
            table, m, d = _surprise(x[half != h], lab[half != h])
            beyond.append(x[held].astype(np.float32) @ table - m - SHORT * d / np.sqrt(counts[held]))
    if not beyond:
        return s, spread, np.inf
    most = float(np.quantile(np.concatenate(beyond), 1 - STRAY))
    return s, spread, mean + max(LEAST_SURPRISE, SURPRISE * most)


def fit(features: np.ndarray, labels: list[str], letters: np.ndarray, counts: np.ndarray) -> Model | None:
    """Model from relative n-gram frequencies, which are scaled in place, and language labels;
    letters and counts are the frequencies and numbers of the n-grams of letters."""
    languages = sorted(set(labels))
    if not languages:
        return None
    families = sorted({family_of(x) for x in languages})
    x = features
    x *= np.float32(SCALE)
    lab = np.array([languages.index(v) for v in labels])
    fam = np.array([families.index(family_of(v)) for v in labels])
    cols, bias, pairs = [], [], []
    for k in range(len(families)):
        if len(families) == 1:
            w, b = np.zeros(x.shape[1]), 0.0
        else:
            y = np.where(fam == k, 1.0, -1.0)
            w, b = _svm(x, y, _balanced(y))
        cols.append(w * SCALE * 2)
        bias.append(b * 2)
    for a, b_ in combinations(range(len(languages)), 2):
        if family_of(languages[a]) != family_of(languages[b_]):
            continue
        rows = (lab == a) | (lab == b_)
        y = np.where(lab[rows] == a, 1.0, -1.0)
        w, b = _svm(x[rows], y, _balanced(y))
        cols.append(w * SCALE * 4)
        bias.append(b * 4)
        pairs.append((a, b_))
    weights = np.stack(cols, 1).astype(np.float32)
    return Model(languages, families, weights, np.array(bias), pairs, *_calibrated(letters, counts, lab))


_FREQUENCIES = pa.struct([("f", pa.binary()), ("letters", pa.binary()), ("n", pa.float64())])


@F.arrow_udf(T.StructType().add("f", T.BinaryType()).add("letters", T.BinaryType()).add("n", T.DoubleType()))
def _frequencies(text: pa.Array) -> pa.Array:
    """Relative n-gram frequencies of each text as float32 bytes; of those of letters as float16, and their number."""
    buf, offsets = B.utf8(text)
    rows = []
    for i in range(len(offsets) - 1):
        part = buf[offsets[i] : offsets[i + 1]]
        count, letters = np.zeros((2, DIMENSIONS))
        for at, hi, ids, keep in _chunks(part, np.array([0, len(part)])):
            count += np.bincount(ids[keep], minlength=DIMENSIONS)
            lo = max(0, at - 3)
            keep &= _of_letters(part[lo:hi])[at - lo :]
            letters += np.bincount(ids[keep], minlength=DIMENSIONS)
        n = letters.sum()
        rows.append({
            "f": (count / max(1.0, count.sum())).astype(np.float32).tobytes(),
            "letters": (letters / max(1.0, n)).astype(np.float16).tobytes(), "n": n,
        })
    return pa.array(rows, _FREQUENCIES)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(
    labelled: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> Model | None:
    """Learn from a bounded sample of rows with a language and a letter in the text.

    The sample takes at most about SAMPLE_PER_LANGUAGE rows of each language and SAMPLE_ROWS in
    all, chosen by a hash of the key; only their hashed frequencies reach the driver.
    """
    C.ship(labelled.sparkSession)
    rows = labelled.select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).alias("key")
    ).where(F.col("lang").isNotNull())
    counts = C.cut(rows.groupBy("lang").agg(F.count("*").alias("count")))
    n = counts.count()
    if not n:
        return None
    each = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // n))
    drawn = (
        rows.join(F.broadcast(counts) if C.within_bytes(n, 100) else counts, "lang")
        .withColumn("o", C.unit_hash(F.col("key"), F.lit("language")))
        .where((F.col("o") < each / F.col("count")) & has_letter(F.col("text")))
        .select("lang", "o", _frequencies("text").alias("f"))
        .limit(2 * each * n)
    )
    got = [
        (r["lang"], r["o"], np.frombuffer(r["f"]["f"], np.float32), np.frombuffer(r["f"]["letters"], np.float16), r["f"]["n"])
        for r in drawn.toLocalIterator()
    ]
    # a fixed order makes the fit repeatable
    got.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    features, letters = np.empty((len(got), DIMENSIONS), np.float32), np.empty((len(got), DIMENSIONS), np.float16)
    for i, r in enumerate(got):
        features[i], letters[i] = r[2], r[3]
    counts = np.array([r[4] for r in got])
    labels = [r[0] for r in got]
    del got
    return fit(features, labels, letters, counts)


def predict(
    df: DataFrame, model: Model | None, *, text: str = "text", to: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """df with the predicted language and its score."""
    C.ship(df.sparkSession)
    name, score = to
    t = F.col(f"`{text}`").cast("string")
    if model is None:
        got = F.struct(F.lit("und").alias(name), F.lit(0.0).alias(score))
        both = C.free_name(df, "__lang")
        return C.replace_columns(df.withColumn(both, got), both, [name, score])

    @F.arrow_udf("struct<lang: string, score: double>")
    def classify(column: pa.Array) -> pa.Array:
        buf, offsets = B.utf8(column)
        names, scores = [], []
        for i, j in B.slices(offsets, B.SLICE_BYTES // 4):
            best, p = model.predict(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            names += [model.languages[k] for k in best]
            scores.append(p)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))],
            names=["lang", "score"],
        )

    known = has_letter(t)
    hit, both = C.free_name(df, "__hit"), C.free_name(df, "__lang")
    found = df.withColumn(hit, classify(t)).withColumn(
        both,
        F.struct(
            F.when(known, F.col(f"{hit}.lang")).otherwise("und").alias(name),
            F.when(known, F.col(f"{hit}.score")).otherwise(0.0).alias(score),
        ),
    )
    return C.replace_columns(found.drop(hit), both, [name, score])


def identified(text: Column, model: Model | None) -> Column:
    """The learned language of a text, null for a text that has no letter or is in none of them."""
    if model is None:
        return F.lit(None).cast("string")

    @F.arrow_udf("string")
    def name(column: pa.Array) -> pa.Array:
        buf, offsets = B.utf8(column)
        out = []
        for i, j in B.slices(offsets, B.SLICE_BYTES // 4):
            part, at = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            known = model.known(part, at)
            best, _ = model.predict(part, at)
            out += [model.languages[k] if ok else None for k, ok in zip(best, known, strict=True)]
        B.give_back()
        return pa.array(out, pa.string())

    # a filter on the result would be moved before it with a copy of the work
    return F.when(has_letter(text), name.asNondeterministic()(text))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; documents whose fold is 1 are held out of training."""
    docs = C.table(spark, sf_dir, "documents")
    model = train(docs.where(C.fold("doc_id", 3) != 1))
    return predict(
        docs.select("doc_id", (C.fold("doc_id", 3) == 1).alias("held_out"), "text"), model
    ).drop("text")
