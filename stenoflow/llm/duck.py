"""Parts of the SQL counterparts that several queries share."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, by its rule: eight steps for each byte."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
 lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda c, i: {step})))"""
