"""Reading the stream log from a start position."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import LOG
from tradelake.sources.files import hadoop_path
from tradelake.sources.log import last_positions, read_log

EARLIEST = "TRIM_HORIZON"
LATEST = "LATEST"


def read_stream(
    spark: SparkSession,
    path: str,
    start: str | datetime | dict[int, int] = EARLIEST,
    checkpoint: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Stream all shards of a log.

    ``start`` is the oldest record, the newest one at the time of the call, a
    time, or a map of shard to the position to go on behind. For LATEST
    give the query's checkpoint: the positions are kept next to it, so that a
    restarted query skips only what was there at its first start.
    ``max_files`` and ``max_bytes`` limit one batch.
    """
    reader = spark.readStream.schema(LOG)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    stream = reader.parquet(path)
    if start == EARLIEST:
        return stream
    if isinstance(start, datetime):
        return stream.filter(F.col("arrival_ts") >= F.lit(start))
    if start == LATEST:
        start = _first_start(spark, path, checkpoint)
    return _behind(stream, start)


def _behind(stream: DataFrame, positions: dict[int, int]) -> DataFrame:
    if not positions:
        return stream
    pairs = [F.lit(number) for entry in sorted(positions.items()) for number in entry]
    last = F.try_element_at(F.create_map(*pairs), F.col("shard"))
    return stream.filter(last.isNull() | (F.col("position") > last))


def _first_start(spark: SparkSession, path: str, checkpoint: str | None) -> dict[int, int]:
    if checkpoint is None:
        raise ValueError("LATEST needs the query's checkpoint folder")
    kept = f"{checkpoint.rstrip('/')}-start"
    done, fs = hadoop_path(spark, f"{kept}/_SUCCESS")
    if not fs.exists(done):
        found = list(last_positions(read_log(spark, path)).items())
        frame = spark.createDataFrame(found, "shard int, position bigint")
        frame.coalesce(1).write.mode("overwrite").parquet(kept)
    rows = spark.read.schema("shard int, position bigint").parquet(kept).collect()
    return {row["shard"]: row["position"] for row in rows}
