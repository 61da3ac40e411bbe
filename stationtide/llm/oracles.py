"""Pieces of DuckDB SQL that several comparisons share."""

from __future__ import annotations


def crc_table_sql() -> str:
    """One row with ``crc``, the 256 entries of the CRC-32 table, from its rule."""
    return ("SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: "
            "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc")


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text of code points below 2048; needs ``crc`` of ``crc_table_sql``."""
    points = f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {points}), lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"
