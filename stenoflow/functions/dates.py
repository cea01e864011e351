"""Dates and clock times from strings; what does not parse is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names of the languages whose transcripts spell them out.
MONTHS = {
    "english": "january february march april may june july august september october november december",
    "norwegian": "januar februar mars april mai juni juli august september oktober november desember",
    "latvian": "janvāris februāris marts aprīlis maijs jūnijs jūlijs augusts septembris oktobris novembris decembris",
    "albanian": "janar shkurt mars prill maj qershor korrik gusht shtator tetor nëntor dhjetor",
}


def parse(x: Column, formats: list[str]) -> Column:
    """Date by the first of the formats that fits."""
    return F.coalesce(*[F.try_to_date(x, f) for f in formats])


def month_number(name: Column, language: str = "english") -> Column:
    pairs = [F.lit(v) for i, m in enumerate(MONTHS[language].split(), 1) for v in (m, i)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(name)))


def spelled(x: Column, language: str = "english") -> Column:
    """'4 March 2020' or '4. mars 2020' as a date."""
    pattern = r"^\s*(\d{1,2})\.?\s+(\p{L}+)\s+(\d{4})\s*$"
    part = lambda i: F.nullif(F.regexp_extract(x, pattern, i), F.lit(""))
    text = F.concat_ws("-", part(3), F.lpad(month_number(part(2), language).cast("string"), 2, "0"), F.lpad(part(1), 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def before_bracket(x: Column) -> Column:
    return F.trim(F.split_part(x, F.lit("("), F.lit(1)))


def day_key(d: Column) -> Column:
    return F.date_format(d, "ddMMyyyy")


def srt_seconds(x: Column) -> Column:
    """'HH:MM:SS,mmm' in seconds."""
    p = r"(\d+):(\d{2}):(\d{2})[,.](\d{1,3})"
    n = lambda i: F.expr("try_cast(null as double)") if i < 0 else F.regexp_extract(x, p, i).try_cast("double")
    return n(1) * 3600 + n(2) * 60 + n(3) + n(4) / 1000


def minute_clock(x: Column) -> Column:
    """'MM:SS' in seconds, other shapes null."""
    parts = F.split(x, ":")
    at = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("int")
    return F.when(F.size(parts) == 2, at(1) * 60 + at(2))


def decimal_clock(x: Column) -> Column:
    """13.07 as '13:07'."""
    return F.format_string("%02d:%02d", F.floor(x).cast("int"), F.round((x - F.floor(x)) * 100).cast("int"))


def clock(seconds: Column) -> Column:
    """Seconds as HH:MM:SS."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
