"""Trade files: CSV input, raw JSON lines, processed Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import records
from tradelake.functions.text import decode_key, output_id, strip
from tradelake.operators.trades import refine
from tradelake.schemas import PROCESSED, PROCESSED_PARTITIONS, TRADE_TEXT


def read_trades_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Comma-separated trades with a header, every column as text.

    Columns are found by header name. Files that are read together need the same
    header; one with another order fails and is not read with its values swapped.
    Quotes inside quotes are doubled and a backslash is a plain character.
    ``multiline`` accepts line breaks inside quotes but reads each file in one task.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    found = reader.option("escape", '"').option("multiLine", multiline).csv(path)
    if not found.columns:
        return spark.createDataFrame([], TRADE_TEXT)
    missing = [name for name in TRADE_TEXT.names if name not in found.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return found.select(*TRADE_TEXT.names)


def parse_raw(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON lines to typed trades, by the number rules the check used.

    A plain JSON read would lose records the check lets pass, such as ``"12"``
    or ``1.7`` in an integer field.
    """
    kept = [name for name in df.columns if name != value and name not in TRADE_TEXT.names]
    parsed = df.withColumn("_fields", records.trade_fields(strip(F.col(value))))
    # As a generator, so that filters above do not repeat the parse.
    trade = F.inline(F.array(F.struct(*records.typed_trade(F.col("_fields")))))
    return parsed.select(trade, *kept)


def typed_records(df: DataFrame, record: str = "record") -> DataFrame:
    """Landed records to typed trades, by the number rules the check used; no text is parsed again."""
    kept = [name for name in df.columns if name != record and name not in TRADE_TEXT.names]
    parsed = df.withColumn("_fields", records.record_fields(F.col(record)))
    return parsed.select(F.inline(F.array(F.struct(*records.typed_trade(F.col("_fields"))))), *kept)


def read_raw(spark: SparkSession, path: str, parts: str = "") -> DataFrame:
    """The raw zone as typed trades. ``parts`` names path columns, such as ``month string``."""
    schema = "value string" + (f", {parts}" if parts else "")
    return parse_raw(spark.read.schema(schema).text(path))


def write_processed(refined: DataFrame, path: str) -> None:
    """Append to the processed zone, one folder per symbol and event hour.

    The hint gathers a partition's rows, and adaptive execution splits a
    partition that is too large for one task and merges the small ones. A zone
    that a stream fills must not be written this way: its readers go by the
    stream's commit log.
    """
    gathered = refined.hint("rebalance", *PROCESSED_PARTITIONS)
    gathered.write.mode("append").partitionBy(*PROCESSED_PARTITIONS).option(
        "compression", "snappy"
    ).parquet(path)


def input_id(path: Column) -> Column:
    """A folder name for an input file: the end of its decoded name, told apart by a digest of its path."""
    key = decode_key(path)
    return F.concat_ws("-", F.left(F.md5(key.cast("binary")), F.lit(8)), F.regexp_replace(output_id(key), "[^A-Za-z0-9._-]", "_"))


def refine_again(spark: SparkSession, raw: str | list[str], processed: str) -> None:
    """Refine raw files so that a repeated run replaces what it wrote before.

    Each input has a folder of its own below a symbol's hour, named by :func:`input_id`.
    Only folders of the inputs of this run are replaced; those of other inputs in the same
    hours stay. An hour in which a changed input has no trade any more keeps its old ones.
    A zone that a stream fills must not be written this way.
    """
    reader = spark.read.schema("value string").option("recursiveFileLookup", True)
    lines = reader.text(raw).select("value", input_id(F.col("_metadata.file_path")).alias("input"))
    refined = refine(parse_raw(lines), "input").hint("rebalance", *PROCESSED_PARTITIONS, "input")
    writer = refined.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.partitionBy(*PROCESSED_PARTITIONS, "input").parquet(processed)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The processed zone; filters on its path columns prune folders."""
    return spark.read.schema(PROCESSED).parquet(path)
