"""Pieces of SQL that the SQL forms of the operators share."""

from __future__ import annotations

#: Table of the CRC-32 polynomial 0xEDB88320, made by its rule.
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc_of_byte
  FROM range(256) r(i))"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; ``crc_table`` must be joined."""
    count = f"octet_length(encode({text}))"
    as_bytes = f"list_transform(range({count}), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc_of_byte[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {as_bytes}), {step}))"


def ascii_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
