"""CRC-32 and ASCII lower case as DuckDB SQL, for the texts that queries have to agree with."""

from __future__ import annotations

#: One row with the 256 remainders of a byte, by the polynomial of the checksum, reflected.
TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda r, i:
    CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS remainders)
"""


def crc32(text: str, remainders: str = "remainders") -> str:
    """The unsigned checksum of the UTF-8 bytes of a text that is not empty."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)"
    step = f"lambda r, b: xor(r >> 8, {remainders}[1 + (xor(r, b) & 255)])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), {step}), 4294967295)"


def lower_ascii(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
