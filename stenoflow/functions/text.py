"""Text functions as Catalyst expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character references with a meaning in transcripts.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&middot;": "·", "&copy;": "©", "&amp;": "&"}


def collapse(x: Column) -> Column:
    """Trimmed, with every run of white space as one blank."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def strip_tags(x: Column) -> Column:
    return F.regexp_replace(x, r"<[^>]+>", "")


def collapse_blank_lines(x: Column) -> Column:
    return F.regexp_replace(x, r"\n\s*\n", "\n\n")


def expand_abbreviations(x: Column, table: dict[str, str], *, unicode_words: bool = True) -> Column:
    """Whole-word replacement, one abbreviation after the other, in the order of the table."""
    flag = "(?U)" if unicode_words else ""
    quote = lambda s: s.replace("\\", "\\\\").replace("$", "\\$")
    return reduce(
        lambda c, kv: F.regexp_replace(c, rf"{flag}\b\Q{kv[0]}\E\b", quote(kv[1])), table.items(), x
    )


def unescape(x: Column) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), ENTITIES.items(), x)


def html_to_text(x: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags go, pieces are joined by blanks."""
    bare = F.regexp_replace(x, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    return collapse(unescape(F.regexp_replace(bare, r"<[^>]+>", " ")))


def html_paragraphs(x: Column) -> Column:
    """Texts of the p elements, joined by line ends; empty ones go."""
    found = F.regexp_extract_all(x, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1))
    texts = F.transform(found, lambda p: collapse(unescape(F.regexp_replace(p, r"<[^>]+>", " "))))
    return F.array_join(F.filter(texts, lambda t: t != ""), "\n")


def tokens(x: Column) -> Column:
    """White-space tokens, as Python's str.split() gives them."""
    clean = collapse(x)
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def words(x: Column) -> Column:
    """As tokens, with all white space of Unicode."""
    return F.filter(F.split(x, r"(?U)[\s\x1c-\x1f]+", -1), lambda w: w != "")


def normalise_for_wer(x: Column) -> Column:
    """Lower case, bracketed parts gone, marks, signs and punctuation as blanks, white space collapsed."""
    bare = F.regexp_replace(F.lower(x), r"[<\[][^>\]]*[>\]]|\([^)]*\)", "")
    return collapse(F.regexp_replace(bare, r"[\p{M}\p{S}\p{P}]", " "))


def ascii_only(x: Column) -> Column:
    return F.regexp_replace(x, r"[^\x00-\x7F]", "")


#: Characters that stand for words in word_distance: one code point for each distinct word of a pair.
_FIRST_CODE = 0x4E00


def word_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance of two token arrays, by writing each distinct word of the pair as one character.

    Holds for up to 16,000 distinct words in a pair.
    """
    known = F.array_distinct(F.concat(a, b))
    alphabet = F.lit("".join(chr(_FIRST_CODE + i) for i in range(16_000)))
    spell = lambda t: F.array_join(F.transform(t, lambda w: F.substring(alphabet, F.array_position(known, w).cast("int"), F.lit(1))), "")
    return F.levenshtein(spell(a), spell(b))


def by_rules(x: Column, rules: list[tuple[str, list[str]]], default: str | None = None) -> Column:
    """Label of the first rule any of whose keywords the lower-cased text contains."""
    low = F.lower(x)
    parts = [
        F.when(reduce(lambda p, q: p | q, [F.contains(low, F.lit(w)) for w in words]), F.lit(label))
        for label, words in rules
    ]
    return F.coalesce(*parts, F.lit(default))
