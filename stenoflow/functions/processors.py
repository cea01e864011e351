"""Extension points: text processors by parliament, preprocessing by file type, and data contracts."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.functions import text as X

ColumnFunction = Callable[[Column], Column]


class Processors:
    """HTML processors by parliament: column functions, or Python functions run as Arrow-batched UDFs."""

    def __init__(self, default: ColumnFunction = X.html_to_text):
        self.default = default
        self.known: dict[str, ColumnFunction] = {}

    def register(self, parliament: str, make: ColumnFunction) -> None:
        self.known[parliament] = make

    def register_python(self, parliament: str, process: Callable[[str], str]) -> None:
        """A per-text Python function; a text that it fails on is null."""

        def safe(x):
            try:
                return None if x is None else process(x)
            except Exception:
                return None

        @F.pandas_udf(T.StringType())
        def run(s: pd.Series) -> pd.Series:
            return s.map(safe)

        self.known[parliament] = run

    def apply(self, parliament: Column, html: Column) -> Column:
        """Each row by its parliament's processor, others by the default."""
        out = None
        for p, make in self.known.items():
            value = make(F.when(parliament == p, html))
            out = F.when(parliament == p, value) if out is None else out.when(parliament == p, value)
        return self.default(html) if out is None else out.otherwise(self.default(html))


def preprocess(ext: Column, content: Column, abbreviations: dict[str, str] | None = None) -> Column:
    """Clean text of a transcript file by its extension; other types are null.

    Abbreviations are expanded in HTML only.
    """
    low = F.lower(ext)
    page = X.html_to_text(content)
    srt = X.collapse(X.strip_tags(F.regexp_replace(F.regexp_replace(content, "\r\n?", "\n"), r"(?m)^(?:\d+|\d+:\d{2}:\d{2}[,.]\d+ --> .*)$", " ")))
    return (
        F.when(low == "txt", X.collapse(content)).when(low == "srt", srt)
        .when(low.isin("html", "htm"), X.expand_abbreviations(page, abbreviations) if abbreviations else page)
    )


def video_link(url: Column) -> Column:
    """(url, kind) of a link: stream, file, page or nothing."""
    kind = (
        F.when(url.rlike(r"(?i)\.m3u8(\?|$)"), "m3u8").when(url.rlike(r"(?i)youtu\.?be"), "youtube")
        .when(url.rlike(r"(?i)\.(mp4|mp3|webm)(\?|$)"), "file").when(url.rlike(r"(?i)^https?://"), "page")
    )
    return F.when(kind.isNotNull(), F.struct(url.alias("url"), kind.alias("kind")))


def require_processors(df: DataFrame, needed: dict[str, str], known: set[str]) -> None:
    """Raises when a column of the manifest needs a processor that is not registered."""
    missing = {c: p for c, p in needed.items() if c in df.columns and p not in known}
    if missing:
        raise ValueError(f"columns without a processor: {missing}")


def check_metrics(metrics: dict, schema: T.StructType) -> list[str]:
    """Unknown, missing and wrongly typed fields of a metrics record."""
    names = {f.name: f for f in schema}
    kinds = {T.LongType(): int, T.IntegerType(): int, T.DoubleType(): (int, float), T.StringType(): str, T.BooleanType(): bool}
    wrong = [f"unknown: {k}" for k in metrics if k not in names]
    wrong += [f"missing: {k}" for k, f in names.items() if k not in metrics and not f.nullable]
    for k, v in metrics.items():
        f = names.get(k)
        if f is not None and v is not None and (not isinstance(v, kinds[f.dataType]) or isinstance(v, bool) != (f.dataType == T.BooleanType())):
            wrong.append(f"type: {k}")
    return wrong


def quarantine(df: DataFrame, column: str, allowed: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) by a closed set of values; null is rejected."""
    good = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.where(good), df.where(~good)
