"""Topic records: regex subscription and record transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import TOPIC_RECORD


def matching(df: DataFrame, pattern: str) -> DataFrame:
    """Records whose whole topic name matches the pattern."""
    return df.filter(F.col("topic").rlike(rf"\A(?:{pattern})\z"))


def read_topics(spark: SparkSession, path: str, pattern: str, max_files: int | None = None) -> DataFrame:
    """Stream the topics matching ``pattern`` out of a file-backed topic log."""
    reader = spark.readStream.schema(TOPIC_RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return matching(reader.parquet(path), pattern)


def read_kafka(
    spark: SparkSession, servers: str, pattern: str, start: str = "earliest", max_records: int | None = None
) -> DataFrame:
    """The same from a deployed Kafka connector, at most ``max_records`` in a batch."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribePattern", pattern).option("startingOffsets", start)
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load().select(*TOPIC_RECORD.names)


def hoist(df: DataFrame, field: str = "msg_payload") -> DataFrame:
    """The whole value becomes one field; bytes appear as base64 in JSON."""
    return df.withColumn(field, F.base64(F.col("value"))).drop("value")


# The field each piece of record metadata is stored in.
METADATA = {"partition": "msg_partition", "offset": "msg_offset", "timestamp": "msg_ts"}


def insert_metadata(df: DataFrame, names: dict[str, str] = METADATA) -> DataFrame:
    """Add partition, offset and time (epoch milliseconds) as fields of the value."""
    found = {
        "partition": F.col("partition"),
        "offset": F.col("offset"),
        "timestamp": F.unix_millis("timestamp"),
    }
    return df.withColumns({names[key]: found[key] for key in found if key in names})


def archive_transform(df: DataFrame) -> DataFrame:
    """Hoist, then insert metadata, then the JSON text to archive."""
    fields = ["msg_payload", *METADATA.values()]
    whole = df.transform(hoist).transform(insert_metadata)
    return whole.withColumn("value", F.to_json(F.struct(*fields)))
