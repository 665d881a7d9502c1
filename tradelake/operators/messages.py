"""Test loads: faulty messages and repeated records."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.records import NUMBERS
from tradelake.functions.text import preview
from tradelake.schemas import TRADE

#: Number fields that have to be above zero.
POSITIVE = ("price", "amount")

#: A sound trade, from which each fault departs in one point.
SOUND = {
    "transaction_ts": 1_700_000_000, "symbol": "SYM_0", "price": 8.0, "amount": 4.0,
    "dollar_amount": 32.0, "type": "buy", "trans_id": 1,
}


def faults() -> list[tuple[str | None, str]]:
    """Key and text of one message for each way to break a rule of the check.

    Every required field is left out once, every number field holds text once, every
    field that has to be positive is negated once, and one message is no JSON.
    """
    spoiled = [{k: v for k, v in SOUND.items() if k != name} for name in TRADE.names]
    spoiled += [{**SOUND, name: SOUND["symbol"]} for name in NUMBERS]
    spoiled += [{**SOUND, name: -SOUND[name]} for name in POSITIVE]
    return [(message.get("symbol"), json.dumps(message)) for message in spoiled] + [(None, SOUND["symbol"])]


def fault_messages(spark: SparkSession, first_seq: int, arrival: datetime) -> DataFrame:
    """The faulty messages, numbered from ``first_seq``."""
    rows = [(first_seq + i, key, arrival, value) for i, (key, value) in enumerate(faults())]
    return spark.createDataFrame(
        rows, "seq bigint, partition_key string, arrival_ts timestamp, value string"
    )


def inject_faults(messages: DataFrame, first_seq: int, arrival: datetime) -> DataFrame:
    """Messages with the faulty ones mixed in."""
    added = fault_messages(messages.sparkSession, first_seq, arrival)
    return messages.unionByName(added.select(*messages.columns))


def sent_previews(messages: DataFrame) -> DataFrame:
    """Sequence number and the first 80 characters of each payload."""
    return messages.select("seq", preview(F.col("value")).alias("payload"))


def repeat_record(record: DataFrame, n: int, key: str = "1") -> DataFrame:
    """The ``value`` of a record ``n`` times under one key, for load runs."""
    times = record.sparkSession.range(n).withColumnRenamed("id", "seq")
    # One row is broadcast.
    return times.join(F.broadcast(record.select("value").limit(1))).select(
        "seq",
        F.lit(key).alias("partition_key"),
        F.current_timestamp().alias("arrival_ts"),
        "value",
    )
