"""The lake's inputs, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.operators.trades import trade_json
from tradelake.schemas import TRADE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades, plus an arrival time up to two hours behind the event time."""
    ts = F.col("ts").cast("timestamp")
    amount = (F.col("event_id") % 7 + 1).cast("double")
    bought = F.col("event_type").isin("purchase", "click")
    return table(spark, sf_dir, "events").select(
        F.unix_seconds(ts).alias("transaction_ts"),
        F.concat(F.lit("SYM_"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        F.col("value").alias("price"),
        amount.alias("amount"),
        (F.col("value") * amount).alias("dollar_amount"),
        F.when(bought, "buy").otherwise("sell").alias("type"),
        F.col("event_id").alias("trans_id"),
        F.timestamp_seconds(F.unix_seconds(ts) + F.col("event_id") % 7200).alias("arrival_ts"),
    )


TRADES_SQL = """
trades AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS transaction_ts,
         'SYM_' || (user_id % 5) AS symbol,
         value AS price,
         CAST(event_id % 7 + 1 AS DOUBLE) AS amount,
         value * CAST(event_id % 7 + 1 AS DOUBLE) AS dollar_amount,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'buy' ELSE 'sell' END AS type,
         event_id AS trans_id,
         CAST(floor(epoch(ts)) AS BIGINT) + event_id % 7200 AS arrival
  FROM events)
"""

# Of every 20 trades one is spoiled in each of these ways.
CLASSES = 20


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as stream messages; five of every twenty break one rule each."""
    plain = trades(spark, sf_dir)
    kind = F.col("trans_id") % CLASSES
    no_symbol = [name for name in TRADE.names if name != "symbol"]
    no_id = [name for name in TRADE.names if name != "trans_id"]

    def without_price(price: str) -> list:
        return [F.expr(price).alias("price") if name == "price" else F.col(name) for name in TRADE.names]

    value = (
        F.when(kind == 0, F.to_json(F.struct(*no_symbol)))
        .when(kind == 1, F.to_json(F.struct(*without_price("symbol"))))
        .when(kind == 2, F.to_json(F.struct(*without_price("-abs(price) - 1"))))
        .when(kind == 3, F.to_json(F.struct(*no_id)))
        .when(kind == 4, F.col("symbol"))
        .otherwise(trade_json())
    )
    key = F.when(kind.isin(0, 4), F.lit(None)).otherwise(F.col("symbol"))
    return plain.select(
        F.col("trans_id").alias("seq"), key.alias("partition_key"), "arrival_ts", value.alias("value")
    )


# ``sound`` is what the check lets pass: none of the five faults, and a positive price.
SOUND_SQL = TRADES_SQL + """,
sound AS (SELECT * FROM trades WHERE trans_id % 20 > 4 AND price > 0)
"""

REASON_SQL = """
CASE trans_id % 20
  WHEN 0 THEN 'Missing required field: symbol'
  WHEN 1 THEN 'Invalid type: price'
  WHEN 2 THEN 'price and amount must be positive'
  WHEN 3 THEN 'Missing required field: trans_id'
  WHEN 4 THEN 'Invalid JSON'
  ELSE CASE WHEN price <= 0 THEN 'price and amount must be positive' END
END
"""


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic records; errors go to a topic of another naming family."""
    family = F.when(F.col("event_type") == "error", F.lit("raw.")).otherwise(F.lit("json."))
    return table(spark, sf_dir, "events").select(
        F.concat(family, F.col("event_type")).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
    )


TOPICS_SQL = """
topics AS (
  SELECT CASE WHEN event_type = 'error' THEN 'raw.' ELSE 'json.' END || event_type AS topic,
         CAST(event_id % 3 AS INTEGER) AS "partition", event_id AS "offset", ts, props AS value
  FROM events)
"""
