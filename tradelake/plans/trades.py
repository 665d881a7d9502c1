"""Queries over trades and stream messages."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import text, times
from tradelake.operators import indexing, ranking, validation
from tradelake.operators import trades as ops
from tradelake.operators.messages import inject_faults, repeat_record, sent_previews
from tradelake.plans.inputs import (
    REASON_SQL,
    SOUND_SQL,
    TRADES_SQL,
    messages,
    table,
    trades,
)
from tradelake.plans.registry import query
from tradelake.schemas import PROCESSED_COLUMNS, PROCESSED_PARTITIONS, TRADE
from tradelake.session import run_dir
from tradelake.sources.files import export_result
from tradelake.sources.log import to_log, trade_messages
from tradelake.sources.trades import read_trades_csv

BUCKET_SQL = "strftime(make_timestamp(transaction_ts * 1000000), '%Y-%m-%dT%H')"

TOP_SQL = f"""
WITH {TRADES_SQL}, hourly AS (
  SELECT {BUCKET_SQL} AS HourlyBucket,
         CAST(row_number() OVER (PARTITION BY symbol, type, {BUCKET_SQL}
                                 ORDER BY dollar_amount DESC, trans_id) AS INTEGER) AS rnk,
         transaction_ts, symbol, price, amount, dollar_amount, type, trans_id,
         strftime(make_timestamp(transaction_ts * 1000000), '%Y') AS year,
         strftime(make_timestamp(arrival * 1000000), '%m') AS month,
         strftime(make_timestamp(arrival * 1000000), '%d') AS day,
         strftime(make_timestamp(arrival * 1000000), '%H') AS hour
  FROM trades)
SELECT * FROM hourly WHERE rnk = 1
"""


def _arrival_parts(df: DataFrame) -> DataFrame:
    parts = times.padded_parts(F.col("arrival_ts"))
    return df.withColumns({name: parts[name] for name in ("month", "day", "hour")}).drop("arrival_ts")


@query(TOP_SQL)
def top_trades_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrival_parts(ranking.top_trades_per_hour(trades(spark, sf_dir)))


@query(f"""
WITH {TRADES_SQL}
SELECT {BUCKET_SQL} AS HourlyBucket, symbol, type, trans_id,
       row_number() OVER (PARTITION BY symbol, type, {BUCKET_SQL}
                          ORDER BY dollar_amount DESC, trans_id) AS rnk
FROM trades
""")
def ranked_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trades(spark, sf_dir).select("transaction_ts", "symbol", "type", "trans_id", "dollar_amount")
    return ranking.rank_trades_per_hour(rows).drop("transaction_ts", "dollar_amount")


@query(f"""
WITH {TRADES_SQL}
SELECT strftime(make_timestamp(transaction_ts * 1000000), '%Y-%m-%dT%H:00:00') AS bucket,
       symbol, count(*) AS trades, max(price) AS top_price
FROM trades GROUP BY ALL
""")
def hourly_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = times.hour_bucket(times.event_time("transaction_ts"))
    grouped = trades(spark, sf_dir).groupBy(bucket.alias("start"), "symbol")
    return grouped.agg(F.count("*").alias("trades"), F.max("price").alias("top_price")).select(
        F.date_format("start", "yyyy-MM-dd'T'HH:mm:ss").alias("bucket"), "symbol", "trades", "top_price"
    )


@query(f"""
WITH {TRADES_SQL}, clocks AS (
  SELECT trans_id, strftime(make_timestamp(arrival * 1000000), '%Y-%m-%dT%H') AS arrival_hour,
         {BUCKET_SQL} AS event_hour FROM trades)
SELECT *, arrival_hour > event_hour AS late FROM clocks
""")
def late_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_clocks(trades(spark, sf_dir)).select("trans_id", "arrival_hour", "event_hour", "late")


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades through a CSV file in which every fiftieth price is no number."""
    path = run_dir(spark, "csv")
    price = F.when(F.col("trans_id") % 50 == 7, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    rows = trades(spark, sf_dir).withColumn("price", price).select(*TRADE.names)
    rows.write.option("header", True).csv(path)
    return read_trades_csv(spark, path)


@query(f"""
WITH {TRADES_SQL}
SELECT transaction_ts, symbol, price, amount, dollar_amount, type, trans_id
FROM trades WHERE trans_id % 50 <> 7
""")
def scan_trades_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.coerce_trades(_csv(spark, sf_dir))[0]


@query(f"""
WITH {TRADES_SQL}
SELECT CAST(trans_id AS VARCHAR) AS trans_id, symbol, 'n/a' AS price, type
FROM trades WHERE trans_id % 50 = 7
""")
def csv_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.coerce_trades(_csv(spark, sf_dir))[1].select("trans_id", "symbol", "price", "type")


@query(f"""
WITH {TRADES_SQL}, good AS (SELECT * FROM trades WHERE trans_id % 50 <> 7)
SELECT (SELECT count(*) FROM good) AS sent,
       (SELECT count(*) FROM trades WHERE trans_id % 50 = 7) AS errors,
       (SELECT string_agg(trans_id || ':' || symbol, ',' ORDER BY trans_id)
        FROM (SELECT * FROM good ORDER BY trans_id LIMIT 10)) AS sample
""")
def delivery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = ops.delivery_summary(_csv(spark, sf_dir))

    def shown(event: Column) -> Column:
        parts = [F.get_json_object(event, f"$.{name}") for name in ("trans_id", "symbol")]
        return F.concat_ws(":", *parts)

    sample = F.concat_ws(",", F.transform("events_sample", shown))
    return summary.select("sent", "errors", sample.alias("sample"))


SAMPLE_SEED = 7


@query(f"""
WITH {TRADES_SQL}, numbered AS (
  SELECT *, row_number() OVER (ORDER BY trans_id) - 1 AS row_index FROM trades),
draws AS (
  SELECT range AS draw,
         CAST('0x' || substr(md5('{SAMPLE_SEED}:' || range), 1, 15) AS BIGINT)
           % (SELECT count(*) FROM trades) AS row_index
  FROM range((SELECT count(*) FROM trades)))
SELECT draw, trans_id, symbol, price FROM draws JOIN numbered USING (row_index)
""")
def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many draws as there are trades."""
    rows = trades(spark, sf_dir).select("trans_id", "symbol", "price")
    return indexing.sample_exact(rows, rows.count(), SAMPLE_SEED, [F.col("trans_id")])


WORKERS = 25


@query(f"""
WITH {TRADES_SQL}
SELECT trans_id, (row_number() OVER (ORDER BY trans_id) - 1)
       // (SELECT CAST(ceil(count(*) / {WORKERS}.0) AS BIGINT) FROM trades) AS chunk
FROM trades
""")
def chunk_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trades(spark, sf_dir).select("trans_id")
    return indexing.chunk(rows, WORKERS, [F.col("trans_id")]).select("trans_id", "chunk")


@query("""
SELECT event_id, CASE WHEN event_id % 11 > 1 THEN props END AS value FROM events
""")
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 11
    good = text.encode_payload(F.concat(F.lit(" \t"), F.col("props")))
    data = (
        F.when(kind == 0, F.concat(good, F.lit("*")))
        .when(kind == 1, F.base64(F.concat(F.unhex(F.lit("FFFE")), F.encode("props", "UTF-8"))))
        .otherwise(good)
    )
    coded = table(spark, sf_dir, "events").select("event_id", data.alias("data"))
    return validation.decode_envelope(coded).select("event_id", "value")


@query(f"WITH {TRADES_SQL} SELECT trans_id AS seq, {REASON_SQL} AS reason FROM trades")
def validate_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate(messages(spark, sf_dir)).select("seq", "reason")


def _routed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return validation.route(to_log(messages(spark, sf_dir), 4))


@query(f"WITH {SOUND_SQL} SELECT trans_id AS seq, 'Ok' AS result, symbol AS partition_key FROM sound")
def route_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir)[0].select("seq", "result", "partition_key")


@query(f"""
WITH {TRADES_SQL}, checked AS (SELECT *, {REASON_SQL} AS reason FROM trades)
SELECT trans_id AS seq, 'ProcessingFailed' AS result, reason,
       CASE WHEN trans_id % 20 IN (0, 4) THEN 'invalid' ELSE symbol END AS partition_key
FROM checked WHERE reason IS NOT NULL
""")
def route_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir)[1].select("seq", "result", "reason", "partition_key")


@query(f"""
WITH {TRADES_SQL}, checked AS (SELECT {REASON_SQL} AS reason FROM trades),
mixed AS (
  SELECT coalesce(reason, 'good') AS reason FROM checked
  UNION ALL SELECT 'Missing required field: ' || unnest(['transaction_ts', 'symbol', 'price', 'amount',
    'dollar_amount', 'type', 'trans_id'])
  UNION ALL SELECT 'Invalid type: ' || unnest(['transaction_ts', 'price', 'amount', 'dollar_amount', 'trans_id'])
  UNION ALL SELECT unnest(['price and amount must be positive', 'price and amount must be positive', 'Invalid JSON']))
SELECT reason, count(*) AS records FROM mixed GROUP BY reason
""")
def inject_fault_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = trades(spark, sf_dir).agg(F.max("trans_id")).first()[0]
    arrival = datetime(2024, 2, 1, tzinfo=timezone.utc)
    mixed = validation.validate(inject_faults(messages(spark, sf_dir), last + 1, arrival))
    reason = F.coalesce("reason", F.lit("good")).alias("reason")
    return mixed.groupBy(reason).agg(F.count("*").alias("records"))


@query("""
SELECT range AS seq, (SELECT props FROM events ORDER BY event_id LIMIT 1) AS value
FROM range((SELECT count(*) FROM events))
""")
def repeat_one_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event's record as often as there are events."""
    events = table(spark, sf_dir, "events")
    record = events.orderBy("event_id").limit(1).select(F.col("props").alias("value"))
    return repeat_record(record, events.count()).select("seq", "value")


@query("SELECT event_id AS seq, substr(repeat(props, 3), 1, 80) AS payload FROM events")
def preview_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.repeat("props", 3).alias("value"))
    return sent_previews(sent)


@query(f"""
WITH {TRADES_SQL}
SELECT count(*) FILTER (trans_id % 50 <> 7) AS sent, count(*) FILTER (trans_id % 50 = 7) AS errors, true AS timed FROM trades
""")
def delivery_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the pass that writes; ``timed`` if seconds and rate belong together."""
    path = run_dir(spark, "counted")
    found = ops.deliver_counted(_csv(spark, sf_dir), lambda rows: rows.write.parquet(path))
    timed = found["elapsed"] >= 0 and found["rate"] * (found["elapsed"] + 0.01) >= found["sent"] and spark.read.parquet(path).count() == found["sent"]
    return spark.createDataFrame([(found["sent"], found["errors"], timed)], "sent bigint, errors bigint, timed boolean")


@query(f"""
WITH {TRADES_SQL}
SELECT trans_id AS seq,
       'Event: trans_id=' || trans_id || ' symbol=' || symbol || ' price=' || price
         || ' amount=' || amount || ' type=' || type AS line
FROM trades
""")
def format_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.format_events(trade_messages(trades(spark, sf_dir))).select("seq", "line")


REFINED_SQL = """
  SELECT strftime(make_timestamp(transaction_ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS transaction_date,
         price, amount, dollar_amount, type, trans_id, symbol,
         CAST(year(make_timestamp(transaction_ts * 1000000)) AS INTEGER) AS year,
         CAST(month(make_timestamp(transaction_ts * 1000000)) AS INTEGER) AS month,
         CAST(day(make_timestamp(transaction_ts * 1000000)) AS INTEGER) AS day,
         CAST(hour(make_timestamp(transaction_ts * 1000000)) AS INTEGER) AS hour
"""


def _keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of which every fortieth has lost its symbol."""
    symbol = F.when(F.col("trans_id") % 40 != 0, F.col("symbol"))
    return trades(spark, sf_dir).withColumn("symbol", symbol)


KEYED_SQL = f"{TRADES_SQL}, keyed AS (SELECT * FROM trades WHERE trans_id % 40 <> 0)"


@query(f"WITH {KEYED_SQL} {REFINED_SQL} FROM keyed")
def refine_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.refine(_keyless(spark, sf_dir)).select(*PROCESSED_COLUMNS, *PROCESSED_PARTITIONS)


@query(f"WITH {TRADES_SQL} SELECT count(*) AS dropped FROM trades WHERE trans_id % 40 = 0")
def unrefined_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unrefined(_keyless(spark, sf_dir))


@query(f"""
WITH {KEYED_SQL}, refined AS ({REFINED_SQL} FROM keyed)
SELECT symbol, year, month, day, hour, count(*) AS rows FROM refined GROUP BY ALL
""")
def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.group_keys(ops.refine(_keyless(spark, sf_dir)))


@query(f"""
WITH {KEYED_SQL}, refined AS ({REFINED_SQL} FROM keyed)
SELECT DISTINCT 'lake/processed/symbol=' || symbol || '/year=' || year || '/month=' || month
       || '/day=' || day || '/hour=' || hour AS path
FROM refined
""")
def partition_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.partition_paths(ops.refine(_keyless(spark, sf_dir)), "lake/processed")


@query("""
WITH named AS (
  SELECT event_id, 'in box/100%/a+b/avro_' || event_type || '/delivery-'
         || lpad(CAST(event_id AS VARCHAR), 40, '0') AS key FROM events)
SELECT event_id, key, right(key, 36) AS file_id,
       regexp_replace(replace(key, 'avro', 'parquet'), '/[^/]*$', '') AS folder
FROM named
""")
def decode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad(F.col("event_id").cast("string"), 40, "0")
    kind = F.replace("event_type", F.lit("e"), F.lit("%65"))
    coded = F.concat(F.lit("in%20box/100%/a+b/avro%5F"), kind, F.lit("/delivery-"), number)
    keys = table(spark, sf_dir, "events").select("event_id", text.decode_key(coded).alias("key"))
    return keys.select(
        "event_id",
        "key",
        text.output_id(F.col("key")).alias("file_id"),
        text.folder_name(text.mirrored_path(F.col("key"), {"avro": "parquet"})).alias("folder"),
    )


@query(TOP_SQL)
def export_top_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = top_trades_per_hour(spark, sf_dir)
    path = run_dir(spark, "export")
    export_result(result, path)
    return spark.read.option("header", True).schema(result.schema).csv(path)
