"""Reading one JSON trade record: strictness, presence and number rules.

The document is parsed once into a struct of variants. That keeps apart the
three cases the rules need: a missing key is SQL null, a JSON null is a variant
null, and of repeated keys the last one stays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelake.schemas import TRADE

# The number fields in the order in which they are converted.
NUMBERS = {
    "transaction_ts": "bigint",
    "price": "double",
    "amount": "double",
    "dollar_amount": "double",
    "trans_id": "bigint",
}
POSITIVE = ["price", "amount"]

# Texts that count as a number.
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"

# Failure reasons.
BAD_ENCODING = "Invalid encoding"
BAD_JSON = "Invalid JSON"
MISSING = "Missing required field: "
BAD_TYPE = "Invalid type: "
NOT_POSITIVE = "price and amount must be positive"

CORRUPT = "_corrupt"
OPTIONS = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": CORRUPT,
}
FIELDS = ", ".join(f"`{name}` variant" for name in TRADE.names) + f", {CORRUPT} string"


def trade_fields(text: Column) -> Column:
    """The trade fields of a JSON object as variants."""
    return F.from_json(text, FIELDS, OPTIONS)


def _one_document(text: Column) -> Column:
    """Whether the text is exactly one JSON value, with nothing behind it.

    Wrapping in brackets makes trailing text either a syntax error or one more
    element; the second wrap catches text that closes the bracket itself.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    paired = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce((alone == 1) & (paired == 2), F.lit(False))


def _is_object(text: Column) -> Column:
    return F.startswith(text, F.lit("{"))


def _is_strict(text: Column, fields: Column) -> Column:
    """Whether the text is one strict JSON document.

    A parsed object whose first closing brace is its last character has nothing
    behind it, which settles flat records without a second parse.
    """
    parsed = fields[CORRUPT].isNull()
    closed = F.instr(text, "}") == F.length(text)
    other = text.rlike(r'^["\[tfn0-9-]')
    return F.when(_is_object(text), parsed & (closed | _one_document(text))).otherwise(
        other & _one_document(text)
    )


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _long(value: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    from_text = F.when(text.rlike(INT_TEXT), F.btrim(text, F.lit(" \t\n\r\x0b\x0c")).try_cast("bigint"))
    return F.when(_kind(value) == "STRING", from_text).otherwise(
        F.try_variant_get(value, "$", "bigint")
    )


def _double(value: Column, texts: bool) -> Column:
    text = F.try_variant_get(value, "$", "string")
    # A sign before "nan" means nothing, and the cast does not take it.
    plain = F.regexp_replace(F.lower(F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))), "^[+-]nan$", "nan")
    from_text = F.when(text.rlike(FLOAT_TEXT), plain.try_cast("double")) if texts else F.lit(None)
    return F.when(_kind(value) == "STRING", from_text.cast("double")).otherwise(
        F.try_variant_get(value, "$", "double")
    )


def number(fields: Column, name: str) -> Column:
    """The field as a number, or null where the rules refuse it.

    Texts count for the integer fields and for ``dollar_amount``. ``price`` and
    ``amount`` have to be compared with zero and must be real numbers.
    """
    if NUMBERS[name] == "bigint":
        return _long(fields[name])
    return _double(fields[name], texts=name not in POSITIVE)


def failure(text: Column, fields: Column) -> Column:
    """Why the record is refused: the first rule it breaks, or null for a good one."""
    missing_first = F.lit(MISSING + TRADE.names[0])
    rules = [
        F.when(text.isNull(), F.lit(BAD_ENCODING)),
        F.when(~_is_strict(text, fields), F.lit(BAD_JSON)),
        F.when(~_is_object(text), missing_first),
    ]
    rules += [F.when(fields[name].isNull(), F.lit(MISSING + name)) for name in TRADE.names]
    rules += [F.when(number(fields, name).isNull(), F.lit(BAD_TYPE + name)) for name in NUMBERS]
    rules += [F.when(number(fields, name) <= 0, F.lit(NOT_POSITIVE)) for name in POSITIVE]
    return F.coalesce(*rules)


def typed_trade(fields: Column) -> list[Column]:
    """The trade columns with their types, by the same number rules as the check."""
    return [
        number(fields, name).alias(name)
        if name in NUMBERS
        else F.try_variant_get(fields[name], "$", "string").alias(name)
        for name in TRADE.names
    ]


def trade_record(fields: Column) -> Column:
    """The trade fields as one variant object, whatever types their values have."""
    return F.to_variant_object(F.struct(*(fields[name].alias(name) for name in TRADE.names)))


def record_fields(record: Column) -> Column:
    """The fields of :func:`trade_record` again, without any text being parsed."""
    return F.struct(*(F.try_variant_get(record, f"$.{name}", "variant").alias(name) for name in TRADE.names))
