import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and columns that clash with results."""
    long_text = "word " * 30_000 + "token = abcdefgh12345678 end."
    rows = [
        (1, "Plain text of a page.", "en", "a", 5), (1, "Plain text of a page.", "en", "a", 5), (2, "", "en", "a", 0), (3, None, None, None, None),
        (None, "No key here, but five words.", "en", None, 1), (4, " \t\n ", "fr", "b", 3), (5, long_text, "en", "b", 7), (6, "x" * 300_000, "de", "b", 8),
        (7, "1234 5678 !!", "es", "c", 9), (8, "日本語 テキスト ß É ſ", "ja", "c", 1), (None, None, None, None, None), (1, "Another text under a known key.", "en", "a", 2),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: "clash" for c in ("score", "size", "target", "taken", "spans", "secrets", "contamination", "n_tokens", "key", "sig", "component", "position", "epoch", "lang_pred", "offending", "predicted", "n", "p", "q", "at", "k", "row", "t", "__p", "__k", "__t", "__lang", "__hit", "__tox", "__n", "__found", "__sig", "found", "rank", "h")}
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(v).alias(k) for k, v in extra.items()])
