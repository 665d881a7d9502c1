"""Topics to time-partitioned JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.functions import times
from tradelake.streaming.buffering import Limits, buffered, start_buffered
from tradelake.streaming.queries import start
from tradelake.streaming.small_files import read_small_files, small_files

# Records per file, seconds between flushes, and tasks of the hourly archive.
FLUSH_RECORDS = 10
FLUSH_SECONDS = 3
FLUSH_INTERVAL = {"processingTime": "3 seconds"}
FLUSH = Limits(FLUSH_SECONDS, FLUSH_RECORDS)
HOURLY_TASKS = 3


def folders(hourly: bool) -> list[str]:
    """The names of an archive's folders, the outermost first."""
    return ["topic", *times.PARTS[: 4 if hourly else 3]]


def archive_lines(records: DataFrame, hourly: bool = False, *kept: str) -> DataFrame:
    """One JSON line per record with topic and the record's own time as path parts.

    Line breaks in a value become spaces, which mean the same between JSON tokens and are
    not allowed inside its texts. A record without a value is the line ``null``.
    """
    value = F.regexp_replace(F.col("value").cast("string"), r"\R", " ")
    parts = times.plain_parts(F.col("timestamp"), last="hour" if hourly else "day")
    return records.select(
        F.coalesce(value, F.lit("null")).alias("value"),
        "topic",
        *[column.alias(name) for name, column in parts.items()],
        *kept,
    )


def archive_topics(
    records: DataFrame,
    path: str,
    checkpoint: str,
    hourly: bool = False,
    max_records: int = FLUSH_RECORDS,
    tasks: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Archive a topic stream under ``path/topic=/year=/month=/day=[/hour=]``.

    ``max_records`` bounds a file and ``tasks`` the number of tasks that write; a
    continuous run passes :data:`FLUSH_INTERVAL`. The rebalance gathers a folder's
    records and splits a folder too large for one task.
    """
    names = folders(hourly)
    gather = [tasks, *names] if tasks else names
    lines = archive_lines(records, hourly)
    writer = lines.writeStream.foreachBatch(small_files(path, names, max_records, gather))
    return start(writer, path, checkpoint, trigger)


def read_archive(spark: SparkSession, path: str, hourly: bool = False) -> DataFrame:
    """An archive's lines, the parts of their paths as text, and the file of each."""
    return read_small_files(spark, path, folders(hourly))


def archive_buffered(
    records: DataFrame,
    path: str,
    checkpoint: str,
    hourly: bool = False,
    limits: Limits = FLUSH,
    tasks: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Archive like :func:`archive_topics`, with buffers that last over batches.

    Records of a topic's partition and folder wait until ``limits`` flush them, so that a
    stream of small batches fills its files too. A topic's partitions have buffers of their
    own, which spreads a busy topic over tasks.
    """
    names = folders(hourly)
    kept = records.withColumns({"source_partition": F.col("partition"), "source_offset": F.col("offset")})
    lines = archive_lines(kept, hourly, "source_partition", "source_offset")
    full = buffered(lines, [*names, "source_partition"], limits, order="source_offset")
    full = full.select(*names, "source_partition", "source_offset", "value")  # the order of a file's lines
    writer = full.writeStream.foreachBatch(small_files(path, names, limits.records))
    return start_buffered(writer, records.sparkSession, path, checkpoint, tasks, trigger)
