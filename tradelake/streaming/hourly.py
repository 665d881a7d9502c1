"""The largest trade per symbol, side and hour, as a stream that closes hours by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.functions import times
from tradelake.schemas import TRADE
from tradelake.streaming.queries import start

# How long an hour stays open for trades that come late.
LATENESS = "2 hours"


def top_by_hour(trades: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One row per symbol, side and event hour: its largest trade and how many trades it had.

    Ties go to the smaller id. Only the best trade of an open hour is kept in state, so a
    busy symbol costs no more than a quiet one, and each task sends one row per hour and
    group. Trades without a usable time have no hour and are left out.
    """
    timed = trades.withColumn("event_time", times.event_time("transaction_ts")).filter("event_time IS NOT NULL")
    largest = F.struct(F.col("dollar_amount"), -F.col("trans_id"))
    hours = (
        timed.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", "1 hour").alias("hour"), "symbol", "type")
        .agg(F.max_by(F.struct(*TRADE.names), largest).alias("best"), F.count(F.lit(1)).alias("trades"))
    )
    return hours.select(times.hour_text(F.col("hour.start")).alias("HourlyBucket"), F.lit(1).alias("rnk"), "best.*", "trades")


def top_stream(
    trades: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS, trigger: dict | None = None
) -> StreamingQuery:
    """Write each hour once, when the watermark has passed its end; later trades of it are dropped."""
    writer = top_by_hour(trades, lateness).writeStream.outputMode("append").format("parquet")
    return start(writer, path, checkpoint, trigger)


def late_trades(spark: SparkSession, read: int, path: str, checkpoint: str) -> int:
    """How many of ``read`` trades came after their hour was closed.

    They are neither in an hour that was written nor in one that is still open, whose
    counts the state of the query's last batch holds.
    """
    closed = spark.read.parquet(path).agg(F.sum("trades")).first()[0] or 0
    state = spark.read.format("statestore").option("path", checkpoint).load()
    counted = state.schema["value"].dataType.names[-1]
    waiting = state.agg(F.sum(f"value.`{counted}`")).first()[0] or 0
    return read - closed - waiting
