"""Stream log to the raw zone, failed records to the error zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.functions import records, times
from tradelake.functions.text import decode_base64, decode_utf8
from tradelake.operators.validation import FAILED, OK, mark, route
from tradelake.streaming.buffering import Limits, buffered, start_buffered
from tradelake.streaming.queries import NOW, start

# Fixed value: the error class in the path of records the check refused.
ERROR_TYPE = "processing-failed"

# Bytes and seconds a delivery buffers, for ``max_bytes`` of the
# stream and for ``trigger``.
BUFFER_BYTES = 1024 * 1024
BUFFER_INTERVAL = {"processingTime": "60 seconds"}
BUFFER = Limits(60, size=BUFFER_BYTES)

RAW_PARTITIONS = ["year", "month", "day", "hour"]
ERROR_PARTITIONS = ["type", "year", "month", "day"]


def raw_lines(good: DataFrame, *kept: str) -> DataFrame:
    """The payload as one text line with its arrival hour.

    Line breaks inside a strict JSON document can only be blanks between tokens,
    so turning them into spaces keeps both the line and its meaning.
    """
    text = F.regexp_replace(decode_utf8(decode_base64(F.col("data"))), r"\n\z", "")
    line = F.translate(text, "\n\r", "  ")
    return good.select(line.alias("value"), *_parts(times.padded_parts(F.col("arrival_ts"))), *kept)


def error_rows(failed: DataFrame) -> DataFrame:
    """The unchanged payload with its reason, under error class and arrival day."""
    return failed.select(
        "data",
        "reason",
        "arrival_ts",
        F.lit(ERROR_TYPE).alias("type"),
        *_parts(times.padded_parts(F.col("arrival_ts"), last="day")),
    )


def _parts(columns: dict) -> list:
    return [column.alias(name) for name, column in columns.items()]


def once(stream: DataFrame, lateness: str) -> DataFrame:
    """Records of a log stream without the repeats that retried appends leave.

    A repeat has the ``trans_id`` of a record that arrived less than ``lateness`` before; one
    that arrives later is left out too if the watermark had not yet passed the first.
    Only ids the watermark has not passed are in state; records without an id are never
    repeats. What arrives later than the watermark is dropped.
    """
    number = F.get_json_object(decode_utf8(decode_base64(F.col("data"))), "$.trans_id")
    own = F.concat_ws("/", F.lit("at"), "shard", "position")
    named = stream.withColumn("_ident", F.coalesce(F.concat(F.lit("id "), number), own))
    return named.withWatermark("arrival_ts", lateness).dropDuplicatesWithinWatermark(["_ident"]).drop("_ident")


def deliver(
    stream: DataFrame, raw: str, errors: str, checkpoint: str, trigger: dict | None = None, distinct: str | None = None
) -> tuple[StreamingQuery, StreamingQuery]:
    """Validate a stream and write good and failed records to their zones.

    ``distinct`` leaves out repeats that arrive within that time; by default they stay.

    Two queries, each with its own checkpoint and file sink, so each zone gets
    every record exactly once; the price is that records are checked twice. The
    rebalance gathers an hour's records from all shards into few files, and
    adaptive execution splits an hour that is too large for one task.
    """
    good, failed = route(once(stream, distinct) if distinct else stream)
    lines = raw_lines(good).hint("rebalance", *RAW_PARTITIONS)
    refused = error_rows(failed).hint("rebalance", *ERROR_PARTITIONS)
    to_raw = lines.writeStream.format("text").partitionBy(*RAW_PARTITIONS)
    to_errors = refused.writeStream.format("json").partitionBy(*ERROR_PARTITIONS)
    return (
        start(to_raw, raw, f"{checkpoint}/raw", trigger),
        start(to_errors, errors, f"{checkpoint}/errors", trigger),
    )


def deliver_buffered(
    stream: DataFrame, raw: str, checkpoint: str, limits: Limits = BUFFER, trigger: dict | None = None
) -> StreamingQuery:
    """Write good records to the raw zone in files of about a buffer's size.

    A shard's records of an arrival hour wait until there are enough of them or the oldest
    has waited long enough.
    """
    good, _ = route(stream)
    lines = raw_lines(good, "shard", "position")
    full = buffered(lines, [*RAW_PARTITIONS, "shard"], limits, order="position").drop("shard", "position")
    return start_buffered(full.writeStream.format("text").partitionBy(*RAW_PARTITIONS), stream.sparkSession, raw, checkpoint, None, trigger)


def deliver_together(
    stream: DataFrame, raw: str, errors: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write good and failed records to their zones out of one check per record.

    A batch is checked once and kept while both zones are written. Its number is the last
    folder of what it writes, and a batch that is repeated replaces those folders, so each
    record still appears once. The zones show a batch while it is being written.
    """

    def write(batch: DataFrame, number: int) -> None:
        checked = batch.persist()
        try:
            good, failed = (checked.filter(F.col("result") == result) for result in (OK, FAILED))
            _replace(raw_lines(good), raw, RAW_PARTITIONS, number, "text")
            _replace(error_rows(failed), errors, ERROR_PARTITIONS, number, "json")
        finally:
            checked.unpersist()

    return (
        mark(stream).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or NOW))
        .start()
    )


def _replace(rows: DataFrame, path: str, parts: list[str], number: int, fmt: str) -> None:
    gathered = rows.withColumn("batch", F.lit(number).cast("bigint")).hint("rebalance", *parts)
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts, "batch").format(fmt).save(path)


def deliver_records(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Land good records as Parquet: the raw line and, shredded into typed columns, its trade fields.

    Spark infers the columns of the variant ``record`` from each file's values, so that a
    reader takes the fields it asks for without parsing; a value of another type than its
    column's stays in the file as it is. Folders are those of the raw zone.
    """
    good, _ = route(stream)
    lines = raw_lines(good).withColumn("record", records.trade_record(records.trade_fields(F.col("value"))))
    writer = lines.hint("rebalance", *RAW_PARTITIONS).writeStream.format("parquet").partitionBy(*RAW_PARTITIONS)
    return start(writer, path, checkpoint, trigger)
