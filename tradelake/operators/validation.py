"""Check stream records and route them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions import records
from tradelake.functions.text import decode_payload, strip

OK = "Ok"
FAILED = "ProcessingFailed"


def decode_envelope(df: DataFrame, data: str = "data", value: str = "value") -> DataFrame:
    """Add the payload text; null where base64 or UTF-8 is malformed."""
    return df.withColumn(value, decode_payload(F.col(data)))


def validate(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``reason``: null for a good record, else the first rule it breaks."""
    clean, fields = F.col("_text"), F.col("_fields")
    parsed = df.withColumn("_text", strip(F.col(value))).withColumn("_fields", records.trade_fields(clean))
    # A one-element explode, because a filter on a plain column would be pushed
    # down with the expression put in its place, parsing the text for every rule.
    reason = F.explode(F.array(records.failure(clean, fields)))
    return parsed.select(*df.columns, reason.alias("reason"))


def mark(df: DataFrame, data: str = "data") -> DataFrame:
    """Each stream record with its payload text, reason and result; ``data`` is unchanged."""
    checked = validate(decode_envelope(df, data))
    result = F.when(F.col("reason").isNull(), F.lit(OK)).otherwise(F.lit(FAILED))
    return checked.withColumn("result", result)


def route(df: DataFrame, data: str = "data") -> tuple[DataFrame, DataFrame]:
    """Good records and failed records; together they are the input, one to one."""
    marked = mark(df, data)
    return marked.filter(F.col("result") == OK), marked.filter(F.col("result") == FAILED)
