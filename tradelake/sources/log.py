"""The keyed, sharded stream log: Parquet files, one folder per shard.

Its columns match a Kafka or Kinesis record closely, so a deployed connector
takes its place by a change of the reader's format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.text import encode_payload
from tradelake.operators.trades import trade_json
from tradelake.schemas import LOG
from tradelake.sources.files import hadoop_path

# Fixed value: the key of records that have none.
NO_KEY = "invalid"


def shard_of(key: Column, shards: int) -> Column:
    """The shard owning a key: its MD5 falls in one of ``shards`` equal ranges."""
    top = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(top * F.lit(shards).cast("bigint"), 32).cast("int")


def trade_messages(trades: DataFrame, seq: str = "trans_id", arrival: str = "arrival_ts") -> DataFrame:
    """Trades as stream messages: sequence number, key, arrival time and JSON text."""
    return trades.select(
        F.col(seq).alias("seq"),
        F.col("symbol").alias("partition_key"),
        F.col(arrival).alias("arrival_ts"),
        trade_json().alias("value"),
    )


def to_log(messages: DataFrame, shards: int) -> DataFrame:
    """Messages as log records: shard by key, payload encoded."""
    key = F.coalesce(F.col("partition_key"), F.lit(NO_KEY))
    return messages.select(
        F.col("seq").cast("bigint").alias("seq"),
        key.alias("partition_key"),
        "arrival_ts",
        encode_payload(F.col("value")).alias("data"),
        shard_of(key, shards).alias("shard"),
    )


def write_stream_log(messages: DataFrame, path: str, shards: int, max_records: int = 0) -> None:
    """Append messages to the log. One key always lands in one shard.

    Each record gets a position of its own: behind all that the log holds, then in
    the order of shard and sequence number, so that records with equal sequence
    numbers stay apart. Positions ascend with gaps. A shard is a folder, not a
    task: the sort deals a hot shard to several tasks by range. Files are sorted
    by position, so that page reads skip row groups. Appends have to follow each
    other; ``max_records`` bounds a file.
    """
    spark = messages.sparkSession
    _, fs = hadoop_path(spark, path)
    last = None
    if fs.exists(hadoop_path(spark, path)[0]):
        last = read_log(spark, path).agg(F.max("position")).first()[0]
    ordered = to_log(messages, shards).orderBy("shard", "seq", "partition_key", "data")
    placed = ordered.withColumn("position", F.monotonically_increasing_id() + F.lit(0 if last is None else last + 1))
    placed.write.mode("append").partitionBy("shard").option("maxRecordsPerFile", max_records).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a batch."""
    return spark.read.schema(LOG).parquet(path)


def read_page(log: DataFrame, shard: int, after: int | None, limit: int) -> DataFrame:
    """The next ``limit`` records of one shard behind a position; None is the start."""
    page = log.filter(F.col("shard") == shard)
    if after is not None:
        page = page.filter(F.col("position") > after)
    return page.orderBy("position").limit(limit)


def last_positions(log: DataFrame) -> dict[int, int]:
    """The last position of each shard: one row per shard."""
    rows = log.groupBy("shard").agg(F.max("position").alias("position")).collect()
    return {row["shard"]: row["position"] for row in rows}


def kafka_columns(messages: DataFrame) -> DataFrame:
    """Messages as the key and value columns a Kafka sink takes."""
    return messages.select(
        F.col("partition_key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )
