"""New raw files to the processed zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.functions import times
from tradelake.operators.trades import refine, unrefinable
from tradelake.schemas import PROCESSED_PARTITIONS
from tradelake.sources.trades import parse_raw, typed_records
from tradelake.streaming.queries import start


def stream_raw_files(
    spark: SparkSession, raw: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Typed trades of every file that appears in the raw zone, with their line as ``raw_line``."""
    reader = spark.readStream.schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return parse_raw(reader.text(raw).select("value", F.col("value").alias("raw_line")))


def refine_stream(
    spark: SparkSession,
    raw: str,
    processed: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> StreamingQuery:
    """Refine raw files as they come. Late records join their old event hour's folder.

    Lines without a symbol or a usable time are left out; ``observedMetrics`` of each
    batch counts them as ``refining.rejected``, and :func:`reject_stream` keeps them.

    The sink's commit log takes the place of file names derived from the input:
    a repeated batch replaces its own files and never another input's.
    """
    lines = stream_raw_files(spark, raw, max_files, max_bytes)
    kept = F.col("symbol").isNotNull() & times.event_time("transaction_ts").isNotNull()
    counted = lines.observe("refining", F.count(F.lit(1)).alias("lines"), F.count_if(~kept).alias("rejected"))
    refined = refine(counted).hint("rebalance", *PROCESSED_PARTITIONS)
    writer = (
        refined.writeStream.format("parquet")
        .partitionBy(*PROCESSED_PARTITIONS)
        .option("compression", "snappy")
    )
    return start(writer, processed, checkpoint, trigger)


def reject_stream(
    spark: SparkSession,
    raw: str,
    errors: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> StreamingQuery:
    """Raw lines that cannot be refined, as they are, into the error zone.

    It is a query of its own beside :func:`refine_stream`, so that each zone has each
    line once, also after a restart.
    """
    rejected = unrefinable(stream_raw_files(spark, raw, max_files, max_bytes)).select("raw_line")
    writer = rejected.select(F.to_json(F.struct("raw_line")).alias("value")).writeStream.format("text")
    return start(writer, errors, checkpoint, trigger)


def refine_records(
    spark: SparkSession, landed: str, processed: str, checkpoint: str, trigger: dict | None = None, max_files: int | None = None
) -> StreamingQuery:
    """Refine records that :func:`tradelake.streaming.delivery.deliver_records` landed, out of their typed columns."""
    reader = spark.readStream.schema("record variant")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    refined = refine(typed_records(reader.parquet(landed).select("record"))).hint("rebalance", *PROCESSED_PARTITIONS)
    writer = refined.writeStream.format("parquet").partitionBy(*PROCESSED_PARTITIONS).option("compression", "snappy")
    return start(writer, processed, checkpoint, trigger)
