"""Queries over the stream log, the zones, topics and the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import times
from tradelake.functions.text import decode_payload, strip
from tradelake.plans.inputs import (
    REASON_SQL,
    SOUND_SQL,
    TOPICS_SQL,
    TRADES_SQL,
    messages,
    topic_records,
    trades,
)
from tradelake.plans.registry import query
from tradelake.plans.trades import BUCKET_SQL, REFINED_SQL
from tradelake.session import run_dir
from tradelake.sources import catalog, topics
from tradelake.sources import log as logs
from tradelake.sources.files import reset_table
from tradelake.sources.trades import read_processed, read_raw
from tradelake.streaming.archive import FLUSH, FLUSH_RECORDS, HOURLY_TASKS, archive_buffered, archive_topics, read_archive
from tradelake.streaming.buffering import drain
from tradelake.streaming.delivery import deliver
from tradelake.streaming.log import LATEST, read_stream
from tradelake.streaming.queries import BatchCounter, finish, start
from tradelake.streaming.refining import refine_stream, reject_stream

SHARDS = 4

KEY_SQL = "CASE WHEN trans_id % 20 IN (0, 4) THEN 'invalid' ELSE symbol END"
LOG_SQL = f"""
{TRADES_SQL}, keyed AS (SELECT *, {KEY_SQL} AS partition_key FROM trades),
log AS (
  SELECT trans_id AS seq, partition_key, arrival,
         CAST((CAST('0x' || substr(md5(partition_key), 1, 8) AS BIGINT) * {SHARDS}) >> 32 AS INTEGER) AS shard
  FROM keyed)
"""

ARRIVAL_SQL = "strftime(make_timestamp(arrival * 1000000), '{}')"


def _log(spark: SparkSession, sf_dir: str, path: str) -> str:
    where = f"{path}/log"
    logs.write_stream_log(messages(spark, sf_dir), where, SHARDS)
    return where


@query(f"WITH {LOG_SQL} SELECT partition_key, shard, count(*) AS rows FROM log GROUP BY ALL")
def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.read_log(spark, _log(spark, sf_dir, run_dir(spark, "log")))
    return log.groupBy("partition_key", "shard").agg(F.count("*").alias("rows"))


PAGE = 100


@query(f"""
WITH {LOG_SQL}
SELECT seq // 3 AS seq, shard, partition_key FROM log WHERE shard = 0
ORDER BY seq // 3, partition_key LIMIT {PAGE} OFFSET {PAGE}
""")
def read_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a shard in which up to three records share a sequence number."""
    path = run_dir(spark, "log")
    sent = messages(spark, sf_dir).withColumn("seq", F.floor(F.col("seq") / 3))
    logs.write_stream_log(sent, path, SHARDS)
    log = logs.read_log(spark, path)
    first = logs.read_page(log, 0, None, PAGE)
    last = first.agg(F.max("position")).first()[0]
    return logs.read_page(log, 0, last, PAGE).select("seq", "shard", "partition_key")


def _copied(stream: DataFrame, path: str) -> DataFrame:
    """The stream through a file sink and back."""
    finish(start(stream.writeStream.format("parquet"), f"{path}/out", f"{path}/ck"))
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


@query(f"WITH {LOG_SQL} SELECT seq, shard, partition_key, arrival FROM log")
def stream_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "earliest")
    stream = read_stream(spark, _log(spark, sf_dir, path))
    arrival = F.unix_seconds("arrival_ts").alias("arrival")
    return _copied(stream.select("seq", "shard", "partition_key", arrival), path)


@query(f"""
WITH {LOG_SQL}
SELECT seq // 3 AS seq, shard, partition_key FROM log WHERE seq <= (SELECT max(seq) FROM log) // 2
""")
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what was appended after the stream was opened at its end.

    Sequence numbers repeat, and what comes later has the lower ones.
    """
    path = run_dir(spark, "latest")
    sent = messages(spark, sf_dir)
    half = sent.agg(F.max("seq")).first()[0] // 2
    early, late = ((part.withColumn("seq", F.floor(F.col("seq") / 3))) for part in (sent.filter(F.col("seq") > half), sent.filter(F.col("seq") <= half)))
    logs.write_stream_log(early, f"{path}/log", SHARDS)
    stream = read_stream(spark, f"{path}/log", LATEST, checkpoint=f"{path}/ck")
    logs.write_stream_log(late, f"{path}/log", SHARDS)
    return _copied(stream.select("seq", "shard", "partition_key"), path)


@query("SELECT count(*) AS rows FROM events")
def stream_batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a stream read, by the events of its batches of one file each, over 150 of them."""
    path = run_dir(spark, "counts")
    sent = messages(spark, sf_dir)
    logs.write_stream_log(sent, f"{path}/log", SHARDS, max_records=max(1, sent.count() // 160))
    stream = read_stream(spark, f"{path}/log", max_files=1)
    with BatchCounter(spark) as counter:
        running = start(stream.writeStream.format("parquet"), f"{path}/out", f"{path}/ck")
        finish(running)
        counts = counter.counts(running)
    return spark.createDataFrame([(sum(n for _, n in counts),)], "rows bigint")


def _delivered(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = run_dir(spark, label)
    stream = read_stream(spark, _log(spark, sf_dir, path))
    finish(*deliver(stream, f"{path}/raw", f"{path}/errors", f"{path}/ck"))
    return path


@query(f"""
WITH {SOUND_SQL}
SELECT transaction_ts, symbol, price, amount, dollar_amount, type, trans_id,
       {ARRIVAL_SQL.format('%Y')} AS year, {ARRIVAL_SQL.format('%m')} AS month,
       {ARRIVAL_SQL.format('%d')} AS day, {ARRIVAL_SQL.format('%H')} AS hour
FROM sound
""")
def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _delivered(spark, sf_dir, "raw")
    return read_raw(spark, f"{path}/raw", "year string, month string, day string, hour string")


@query(f"""
WITH {TRADES_SQL}, checked AS (SELECT *, {REASON_SQL} AS reason FROM trades)
SELECT reason, arrival, 'processing-failed' AS type, {ARRIVAL_SQL.format('%Y')} AS year,
       {ARRIVAL_SQL.format('%m')} AS month, {ARRIVAL_SQL.format('%d')} AS day,
       CASE WHEN trans_id % 20 = 4 THEN symbol END AS plain,
       CASE WHEN trans_id % 20 NOT IN (3, 4) THEN trans_id END AS trans_id,
       CASE WHEN trans_id % 20 NOT IN (0, 4) THEN symbol END AS symbol,
       CASE trans_id % 20 WHEN 4 THEN NULL WHEN 2 THEN -abs(price) - 1 WHEN 1 THEN NULL ELSE price END AS price,
       CASE WHEN trans_id % 20 <> 4 THEN dollar_amount END AS dollar_amount
FROM checked WHERE reason IS NOT NULL
""")
def stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused records: why, when, where, and what their unchanged payload holds."""
    path = _delivered(spark, sf_dir, "errors")
    schema = (
        "data string, reason string, arrival_ts timestamp,"
        " type string, year string, month string, day string"
    )
    kept = spark.read.schema(schema).json(f"{path}/errors")
    sent = strip(decode_payload(F.col("data")))

    def field(name: str, kind: str) -> Column:
        return F.get_json_object(sent, f"$.{name}").try_cast(kind).alias(name)

    return kept.select(
        "reason", F.unix_seconds("arrival_ts").alias("arrival"), "type", "year", "month", "day",
        F.when(~sent.startswith("{"), sent).alias("plain"),
        field("trans_id", "bigint"), field("symbol", "string"), field("price", "double"), field("dollar_amount", "double"),
    )


@query(f"WITH {SOUND_SQL} {REFINED_SQL} FROM sound")
def stream_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed zone of what a delivery wrote, hour by hour."""
    path = _delivered(spark, sf_dir, "refine")
    finish(refine_stream(spark, f"{path}/raw", f"{path}/processed", f"{path}/ck-refine"))
    return read_processed(spark, f"{path}/processed")


@query(f"""
WITH {TRADES_SQL}
SELECT trans_id % 20 = 0 AS is_json, count(*) AS lines FROM trades WHERE trans_id % 20 IN (0, 4) GROUP BY ALL
""")
def stream_refine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines without a symbol or that are no JSON, from the zone a refining stream sends them to."""
    path = run_dir(spark, "rejects")
    messages(spark, sf_dir).select("value").write.text(f"{path}/raw")
    finish(reject_stream(spark, f"{path}/raw", f"{path}/errors", f"{path}/ck"))
    kept = spark.read.schema("raw_line string").json(f"{path}/errors")
    return kept.groupBy(F.col("raw_line").startswith("{").alias("is_json")).agg(F.count("*").alias("lines"))


# --- catalogue ---------------------------------------------------------------


def _database(path: str) -> str:
    """A database name of its own for a run folder."""
    return path.rsplit("/", 1)[-1].replace("-", "_")


DAILY = "transaction_ts bigint, symbol string, price double, trans_id bigint"
DAILY_PARTS = "year int, month int, day int"


def _daily(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Trades as Parquet, one folder per event day."""
    parts = times.number_parts(times.event_time("transaction_ts"))
    rows = trades(spark, sf_dir).withColumns({name: parts[name] for name in ("year", "month", "day")})
    kept = rows.select("transaction_ts", "symbol", "price", "trans_id", "year", "month", "day")
    kept.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(
        f"{path}/daily"
    )
    return f"{path}/daily"


def _daily_table(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    path = run_dir(spark, "daily")
    data, database = _daily(spark, sf_dir, path), _database(path)
    catalog.recreate_database(spark, database)
    catalog.create_table(spark, f"{database}.daily", DAILY, DAILY_PARTS, data)
    return f"{database}.daily", data


DAY_SQL = f"""
{TRADES_SQL}, daily AS (
  SELECT trans_id, symbol, price, make_timestamp(transaction_ts * 1000000) AS moment FROM trades)
"""


@query(f"""
WITH {DAY_SQL}
SELECT CAST(day(moment) AS INTEGER) AS day, count(*) AS rows, CAST(0 AS BIGINT) AS before
FROM daily GROUP BY ALL
""")
def catalog_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by day after the repair, beside the table's rows before it."""
    name, _ = _daily_table(spark, sf_dir)
    before = spark.table(name).count()
    catalog.repair(spark, name)
    days = spark.table(name).groupBy("day").agg(F.count("*").alias("rows"))
    return days.withColumn("before", F.lit(before).cast("bigint"))


@query(f"""
WITH {DAY_SQL}
SELECT DISTINCT 'year=' || year(moment) || '/month=' || month(moment) || '/day=' || day(moment) AS partition
FROM daily
""")
def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, _ = _daily_table(spark, sf_dir)
    catalog.repair(spark, name)
    return catalog.show_partitions(spark, name)


@query(f"WITH {DAY_SQL} SELECT trans_id, symbol, price FROM daily WHERE day(moment) = 5")
def catalog_add_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _daily_table(spark, sf_dir)
    spec = {"year": 2024, "month": 1, "day": 5}
    catalog.add_partition(spark, name, spec, f"{path}/year=2024/month=1/day=5")
    return spark.table(name).select("trans_id", "symbol", "price")


@query(f"""
WITH {SOUND_SQL}, hourly AS (
  SELECT {BUCKET_SQL} AS HourlyBucket,
         CAST(row_number() OVER (PARTITION BY symbol, type, {BUCKET_SQL}
                                 ORDER BY dollar_amount DESC, trans_id) AS INTEGER) AS rnk,
         transaction_ts, symbol, price, amount, dollar_amount, type, trans_id,
         {ARRIVAL_SQL.format('%m')} AS month, {ARRIVAL_SQL.format('%d')} AS day, {ARRIVAL_SQL.format('%H')} AS hour
  FROM sound)
SELECT * FROM hourly WHERE rnk = 1
""")
def catalog_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest trade per hour, as SQL text on the table a crawl of the raw zone registered."""
    path = _delivered(spark, sf_dir, "crawl")
    database = _database(path)
    catalog.create_zones(spark, {"raw": database})
    catalog.crawl(spark, f"{path}/raw", database, "found_")
    return spark.sql(f"""
        WITH by_hour AS (
          SELECT date_format(timestamp_seconds(transaction_ts), "yyyy-MM-dd'T'HH") AS HourlyBucket, *
          FROM {database}.found_year_2024),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY symbol, type, HourlyBucket
                                       ORDER BY dollar_amount DESC, trans_id) AS rnk
          FROM by_hour)
        SELECT * FROM ranked WHERE rnk = 1 ORDER BY HourlyBucket, symbol, type
    """)


@query(f"WITH {DAY_SQL} SELECT trans_id, symbol, price FROM daily")
def catalog_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled, reset and filled again, the table holds its rows once."""
    name, path = _daily_table(spark, sf_dir)
    catalog.repair(spark, name)
    reset_table(spark, name, path)
    again = trades(spark, sf_dir).select("trans_id", "symbol", "price")
    again.write.parquet(path)
    catalog.create_table(spark, name, again.schema, "", path)
    return spark.table(name)


# --- topics ------------------------------------------------------------------


def _topics(spark: SparkSession, sf_dir: str, path: str) -> str:
    topic_records(spark, sf_dir).write.parquet(f"{path}/topics")
    return f"{path}/topics"


@query(f"""
WITH {TOPICS_SQL}
SELECT topic, value, CAST(year(ts) AS VARCHAR) AS year, CAST(month(ts) AS VARCHAR) AS month,
       CAST(day(ts) AS VARCHAR) AS day
FROM topics WHERE topic LIKE 'json%'
""")
def archive_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic family, values as they are, at most ten in a file."""
    path = run_dir(spark, "archive")
    stream = topics.read_topics(spark, _topics(spark, sf_dir, path), "json.*")
    finish(archive_topics(stream, f"{path}/json", f"{path}/ck"))
    return read_archive(spark, f"{path}/json").drop("file")


@query(f"""
WITH {TOPICS_SQL}
SELECT topic, to_base64(encode(value)) AS msg_payload, "partition" AS msg_partition,
       "offset" AS msg_offset, epoch_us(ts) // 1000 AS msg_ts, CAST(day(ts) AS VARCHAR) AS day,
       CAST(hour(ts) AS VARCHAR) AS hour
FROM topics
""")
def archive_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics by three tasks, payload hoisted and metadata inserted."""
    path = run_dir(spark, "archive")
    stream = topics.read_topics(spark, _topics(spark, sf_dir, path), ".*").transform(
        topics.archive_transform
    )
    finish(archive_topics(stream, f"{path}/all", f"{path}/ck", hourly=True, tasks=HOURLY_TASKS))
    fields = "msg_payload string, msg_partition int, msg_offset bigint, msg_ts bigint"
    stored = read_archive(spark, f"{path}/all", hourly=True)
    return stored.select("topic", F.from_json("value", fields).alias("v"), "day", "hour").select(
        "topic", "v.*", "day", "hour"
    )


@query(f"""
WITH {TOPICS_SQL}
SELECT topic, value, CAST(year(ts) AS VARCHAR) AS year, CAST(month(ts) AS VARCHAR) AS month,
       CAST(day(ts) AS VARCHAR) AS day, true AS within
FROM topics WHERE topic LIKE 'json%'
""")
def archive_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of a stream in several batches, whose buffers were flushed by count and by time.

    ``within`` tells whether a record's file keeps to the number of records.
    """
    path = run_dir(spark, "flush")
    topic_records(spark, sf_dir).repartition(3, "offset").write.parquet(f"{path}/topics")
    stream = topics.read_topics(spark, f"{path}/topics", "json.*", max_files=1)
    drain(archive_buffered(stream, f"{path}/json", f"{path}/ck", trigger={"processingTime": "0 seconds"}), FLUSH)
    kept = read_archive(spark, f"{path}/json")
    sizes = kept.groupBy("file").agg((F.count(F.lit(1)) <= FLUSH_RECORDS).alias("within"))
    return kept.join(sizes, "file").drop("file")
