"""Speeches: turns, headers carried forward, formats and figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rows(group: str, order: str):
    return Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry_forward(df: DataFrame, group: str, order: str, value: Column, name: str) -> DataFrame:
    """df with the last non-null value at or before each row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(_rows(group, order)))


def turns(df: DataFrame, group: str, order: str, is_header: Column, speaker: Column, text: Column) -> DataFrame:
    """(group, turn, speaker, speech): a header starts a speech, later rows append; rows before the first go."""
    numbered = df.withColumn("turn", F.sum(is_header.cast("int")).over(_rows(group, order))).where("turn > 0")
    said = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return numbered.groupBy(group, "turn").agg(
        F.min_by(speaker, F.col(order)).alias("speaker"),
        F.array_join(F.transform(said, lambda s: s["t"]), "\n").alias("speech"),
    )


def formatted(df: DataFrame, group: str, order: str, speaker: Column, text: Column) -> DataFrame:
    """One marked text per session: numbered speeches between rules; an unknown speaker or text is empty."""
    known = lambda c: F.coalesce(c, F.lit(""))
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), known(speaker).alias("s"), known(text).alias("t"))))
    block = lambda r: F.concat(F.lit("[SPEECH] "), r["o"].cast("string"), F.lit("\nSpeaker: "), r["s"], F.lit("\nContent:\n"), r["t"])
    rule = "\n" + "=" * 80 + "\n"
    return df.groupBy(group).agg(F.array_join(F.transform(rows, block), rule).alias("text"))


def content_blocks(x: Column) -> Column:
    """Contents of a marked text, joined by blank lines; empty ones go."""
    found = F.regexp_extract_all(x, F.lit(r"(?s)Content:\n(.*?)(?=\n={80}|\z)"), F.lit(1))
    return F.array_join(F.filter(F.transform(found, lambda b: F.trim(b)), lambda b: b != ""), "\n\n")


def speakers_in_order(df: DataFrame, group: str, order: str, speaker: Column) -> DataFrame:
    """Distinct speakers of each session by first appearance."""
    first = df.select(group, speaker.alias("speaker"), order).where("speaker is not null").groupBy(group, "speaker").agg(F.min(order).alias("at"))
    listed = F.sort_array(F.collect_list(F.struct("at", "speaker")))
    return first.groupBy(group).agg(F.array_join(F.transform(listed, lambda s: s["speaker"]), ",").alias("speakers"))
