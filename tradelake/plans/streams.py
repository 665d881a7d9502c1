"""Queries over streams that keep state or run again: buffers, open hours, repeats, second crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import times
from tradelake.plans.inputs import REASON_SQL, SOUND_SQL, TRADES_SQL, messages, trades
from tradelake.plans.registry import query
from tradelake.plans.trades import BUCKET_SQL, REFINED_SQL
from tradelake.plans.zones import ARRIVAL_SQL, SHARDS
from tradelake.schemas import PROCESSED, TRADE
from tradelake.session import run_dir
from tradelake.sources import catalog
from tradelake.sources import log as logs
from tradelake.sources.crawl import crawl_changes
from tradelake.sources.trades import read_processed, read_raw, refine_again
from tradelake.streaming.buffering import Limits, drain
from tradelake.streaming.delivery import deliver, deliver_buffered, deliver_records, deliver_together
from tradelake.streaming.hourly import late_trades, top_stream
from tradelake.streaming.log import read_stream
from tradelake.streaming.queries import finish
from tradelake.streaming.refining import refine_records

# Trades come in three parts of ten days. Of the first part some come with the last one only.
PARTS_SQL = f"""
{TRADES_SQL}, parts AS (
  SELECT *, make_timestamp(transaction_ts * 1000000) AS moment,
         CASE WHEN trans_id % 50 = 25 AND day(make_timestamp(transaction_ts * 1000000)) <= 10 THEN 3
              ELSE least((day(make_timestamp(transaction_ts * 1000000)) - 1) // 10 + 1, 3) END AS part
  FROM trades),
timely AS (
  SELECT * FROM parts WHERE part < 3 OR moment >= date_trunc('hour', (SELECT max(moment) FROM parts WHERE part < 3) - INTERVAL 2 HOUR))
"""


def _top_of_parts(spark: SparkSession, sf_dir: str, path: str) -> int:
    """Stream the parts one after another, each in a run of its own; the number of trades read."""
    day = F.dayofmonth(F.timestamp_seconds("transaction_ts"))
    held = (F.col("trans_id") % 50 == 25) & (day <= 10)
    part = F.when(held, 3).otherwise(F.least(F.floor((day - 1) / 10) + 1, F.lit(3)))
    rows = trades(spark, sf_dir).select(*TRADE.names, part.alias("part"))
    for number in (1, 2, 3):
        rows.filter(F.col("part") == number).drop("part").write.mode("append").parquet(f"{path}/trades")
        stream = spark.readStream.schema(TRADE).parquet(f"{path}/trades")
        finish(top_stream(stream, f"{path}/top", f"{path}/ck"))
    return rows.count()


@query(f"""
WITH {PARTS_SQL}, ranked AS (
  SELECT {BUCKET_SQL} AS HourlyBucket,
         CAST(row_number() OVER (PARTITION BY symbol, type, {BUCKET_SQL} ORDER BY dollar_amount DESC, trans_id) AS INTEGER) AS rnk,
         transaction_ts, symbol, price, amount, dollar_amount, type, trans_id,
         count(*) OVER (PARTITION BY symbol, type, {BUCKET_SQL}) AS trades, date_trunc('hour', moment) AS hour
  FROM timely)
SELECT * EXCLUDE (hour) FROM ranked
WHERE rnk = 1 AND hour + INTERVAL 1 HOUR <= (SELECT max(moment) FROM parts) - INTERVAL 2 HOUR
""")
def stream_hourly_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest trade of each hour that the last watermark has closed."""
    path = run_dir(spark, "hourly")
    _top_of_parts(spark, sf_dir, path)
    return spark.read.parquet(f"{path}/top")


@query(f"WITH {PARTS_SQL} SELECT (SELECT count(*) FROM parts) - (SELECT count(*) FROM timely) AS late")
def stream_late_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many trades came after their hour was closed."""
    path = run_dir(spark, "late")
    read = _top_of_parts(spark, sf_dir, path)
    return spark.createDataFrame([(late_trades(spark, read, f"{path}/top", f"{path}/ck"),)], "late bigint")


@query(f"""
WITH {TRADES_SQL}, checked AS (SELECT *, {REASON_SQL} AS reason FROM trades),
-- A record without an id cannot be told from its repeat.
kept AS (SELECT *, CASE WHEN trans_id % 20 IN (3, 4) AND trans_id % 3 = 0 THEN 2 ELSE 1 END AS times FROM checked)
SELECT coalesce(reason, 'good') AS reason, CAST(sum(times) AS BIGINT) AS records FROM kept GROUP BY ALL
""")
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both zones of a delivery without repeats, where every third append was retried."""
    path = run_dir(spark, "distinct")
    sent = messages(spark, sf_dir)
    retried = sent.filter(F.col("seq") % 3 == 0).withColumn("arrival_ts", F.col("arrival_ts") + F.expr("INTERVAL 1 MINUTE"))
    for part in (sent, retried):
        logs.write_stream_log(part, f"{path}/log", SHARDS)
        stream = read_stream(spark, f"{path}/log")
        finish(*deliver(stream, f"{path}/raw", f"{path}/errors", f"{path}/ck", distinct="60 days"))
    good = spark.read.schema("value string").text(f"{path}/raw").select(F.lit("good").alias("reason"), "value")
    failed = spark.read.schema("data string, reason string").json(f"{path}/errors").select("reason", F.col("data").alias("value"))
    return good.unionByName(failed).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


@query(f"WITH {SOUND_SQL} {REFINED_SQL} FROM sound")
def refine_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed zone after all raw files were refined and those of five days again."""
    path = run_dir(spark, "twice")
    logs.write_stream_log(messages(spark, sf_dir), f"{path}/log", SHARDS)
    finish(*deliver(read_stream(spark, f"{path}/log"), f"{path}/raw", f"{path}/errors", f"{path}/ck"))
    refine_again(spark, f"{path}/raw", f"{path}/processed")
    refine_again(spark, f"{path}/raw/year=*/month=*/day=0[1-5]", f"{path}/processed")
    return spark.read.parquet(f"{path}/processed").select(*(F.col(f.name).cast(f.dataType) for f in PROCESSED.fields))


@query(f"WITH {SOUND_SQL} {REFINED_SQL} FROM sound")
def refine_landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed zone out of records landed as shredded variants."""
    path = run_dir(spark, "records")
    logs.write_stream_log(messages(spark, sf_dir), f"{path}/log", SHARDS)
    finish(deliver_records(read_stream(spark, f"{path}/log"), f"{path}/landed", f"{path}/ck"))
    finish(refine_records(spark, f"{path}/landed", f"{path}/processed", f"{path}/ck2"))
    return read_processed(spark, f"{path}/processed")


@query(f"""
WITH {TRADES_SQL}, checked AS (SELECT *, {REASON_SQL} AS reason FROM trades)
SELECT coalesce(reason, 'good') AS reason, {ARRIVAL_SQL.format('%d')} AS day,
       CASE WHEN reason IS NULL THEN {ARRIVAL_SQL.format('%H')} END AS hour, count(*) AS records
FROM checked GROUP BY ALL
""")
def stream_zones_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both zones as one query wrote them in several batches."""
    path = run_dir(spark, "together")
    logs.write_stream_log(messages(spark, sf_dir), f"{path}/log", SHARDS)
    stream = read_stream(spark, f"{path}/log", max_files=3)
    finish(deliver_together(stream, f"{path}/raw", f"{path}/errors", f"{path}/ck"))
    good = read_raw(spark, f"{path}/raw", "year string, month string, day string, hour string")
    schema = "data string, reason string, arrival_ts timestamp, type string, year string, month string, day string"
    failed = spark.read.schema(schema).json(f"{path}/errors").select("reason", "day", F.lit(None).cast("string").alias("hour"))
    return good.select(F.lit("good").alias("reason"), "day", "hour").unionByName(failed).groupBy("reason", "day", "hour").agg(F.count(F.lit(1)).alias("records"))


@query(f"""
WITH {SOUND_SQL}
SELECT trans_id, symbol, {ARRIVAL_SQL.format('%d')} AS day FROM sound
""")
def stream_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw zone through buffers that are flushed at 8 KB or after a second."""
    path = run_dir(spark, "buffered")
    logs.write_stream_log(messages(spark, sf_dir), f"{path}/log", SHARDS)
    limits = Limits(1, size=8192)
    stream = read_stream(spark, f"{path}/log")
    drain(deliver_buffered(stream, f"{path}/raw", f"{path}/ck", limits, {"processingTime": "0 seconds"}), limits)
    rows = read_raw(spark, f"{path}/raw", "year string, month string, day string, hour string")
    return rows.select("trans_id", "symbol", "day")


@query(f"""
WITH {TRADES_SQL}, daily AS (SELECT *, CAST(day(make_timestamp(transaction_ts * 1000000)) AS INTEGER) AS d FROM trades)
SELECT trans_id, symbol, CASE WHEN d <= 10 THEN floor(amount) ELSE amount / 2 END AS amount,
       CASE WHEN d > 20 THEN type END AS side, lpad(d::VARCHAR, 2, '0') AS day,
       (SELECT count(DISTINCT d) FROM daily) AS opened, 3 AS crawls
FROM daily
""")
def catalog_recrawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone crawled after each of its three parts: later ones widen a column and add one.

    ``opened`` is the number of files opened by all crawls together, one a day.
    """
    path = run_dir(spark, "recrawl")
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    catalog.create_zones(spark, {"raw": database})
    ts = times.event_time("transaction_ts")
    rows = trades(spark, sf_dir).withColumns({"d": F.dayofmonth(ts), "day": F.date_format(ts, "dd")})
    fields = ["trans_id", "symbol"]
    parts = [
        ("d <= 10", [*fields, F.floor("amount").alias("amount")]),
        ("d > 10 AND d <= 20", [*fields, (F.col("amount") / 2).alias("amount")]),
        ("d > 20", [*fields, (F.col("amount") / 2).alias("amount"), F.col("type").alias("side")]),
    ]
    opened = 0
    for where, columns in parts:
        lines = rows.filter(where).select(F.to_json(F.struct(*columns)).alias("value"), "day").repartition(8, "day")
        lines.write.mode("append").partitionBy("day").text(f"{path}/raw")
        opened += crawl_changes(spark, f"{path}/raw", f"{database}.trades", f"{path}/seen").opened
    found = spark.table(f"{database}.trades")
    return found.select("trans_id", "symbol", "amount", "side", "day", F.lit(opened).cast("bigint").alias("opened"), F.lit(len(parts)).alias("crawls"))
