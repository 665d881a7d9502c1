"""Text, byte and path columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(text: Column) -> Column:
    """Remove whitespace of every kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def decode_base64(text: Column) -> Column:
    """Bytes of a base64 text; null where it is malformed."""
    return F.try_to_binary(text, F.lit("base64"))


def decode_utf8(data: Column) -> Column:
    """Text of UTF-8 bytes; null where they are malformed."""
    return F.try_validate_utf8(data.cast("string"))


def decode_payload(data: Column) -> Column:
    """Text of a base64 stream payload, without surrounding whitespace."""
    return strip(decode_utf8(decode_base64(data)))


def encode_payload(line: Column) -> Column:
    """The reverse: one text line, newline added, as base64."""
    return F.base64(F.encode(F.concat(line, F.lit("\n")), "UTF-8"))


def decode_key(key: Column) -> Column:
    """Percent-decode an object key. ``+`` and stray ``%`` signs stay as they are."""
    kept = F.replace(key, F.lit("+"), F.lit("%2B"))
    kept = F.regexp_replace(kept, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(kept)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """Everything before the last slash."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def output_id(key: Column, length: int = 36) -> Column:
    """The last characters of the base name: the unique part of a delivered file's name."""
    return F.right(base_name(key), F.lit(length))


def mirrored_path(path: Column, swaps: dict[str, str]) -> Column:
    """Replace path fragments one after another, in the given order."""
    for old, new in swaps.items():
        path = F.replace(path, F.lit(old), F.lit(new))
    return path


def partition_path(root: str, columns: list[str], file_name: Column | None = None) -> Column:
    """``root/a=1/b=2[/file]`` out of the row's own columns."""
    parts = [F.lit(root.rstrip("/"))]
    parts += [F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in columns]
    if file_name is not None:
        parts.append(file_name)
    return F.concat_ws("/", *parts)


def preview(text: Column, length: int = 80) -> Column:
    return F.substring(text, 1, length)


def decimal_from_bytes(data: Column, precision: int, scale: int) -> Column:
    """Decimal out of its unscaled value as big-endian two's complement bytes."""
    if precision + scale > 37:
        raise ValueError("precision and scale may not exceed 37 together")
    wide = "decimal(38,0)"

    def add(total: Column, place: Column) -> Column:
        byte = F.conv(F.hex(F.substring(data, place, F.lit(1))), 16, 10).cast("int")
        signed = F.when((place == 1) & (byte >= 128), byte - 256).otherwise(byte)
        return (total * F.lit(256) + signed).cast(wide)

    # An empty value has no place to add and stays zero.
    places = F.filter(F.sequence(F.lit(0), F.octet_length(data)), lambda place: place > 0)
    unscaled = F.aggregate(places, F.lit(0).cast(wide), add)
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(1)
    value = unscaled.try_cast(f"decimal({precision},0)") * unit
    return F.when(data.isNotNull(), value.cast(f"decimal({precision},{scale})"))
