"""Streams that keep state, repeated runs, repeated crawls and footers."""

from __future__ import annotations

import glob
import os
import shutil
from datetime import datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions import records
from tradelake.operators.trades import refine
from tradelake.plans.inputs import messages, topic_records, trades
from tradelake.schemas import TRADE
from tradelake.sources import catalog, topics
from tradelake.sources import log as logs
from tradelake.sources.crawl import crawl_changes, merged, widened
from tradelake.sources.footers import column_bytes, count_from_footers, write_for_lookup
from tradelake.sources.trades import parse_raw, read_raw, refine_again, typed_records
from tradelake.streaming.archive import archive_buffered
from tradelake.streaming.buffering import Limits, buffered, drain
from tradelake.streaming.delivery import deliver, deliver_buffered, deliver_together, once
from tradelake.streaming.hourly import late_trades, top_stream
from tradelake.streaming.log import read_stream
from tradelake.streaming.queries import finish, start


def local(path):
    return path.removeprefix("file:")


def put_records(spark, folder, first, last):
    """Each record in a file, and so in a batch, of its own."""
    for k in range(first, last):
        row = [("json.a", 0, k, datetime(2024, 1, 1, 0, 0, k, tzinfo=timezone.utc), None, f'{{"k":{k}}}'.encode())]
        frame = spark.createDataFrame(row, "topic string, partition int, offset long, timestamp timestamp, key binary, value binary")
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/topics")


def file_sizes(folder):
    return sorted(len(open(f).read().split()) for f in glob.glob(f"{local(folder)}/out/*/*/*/*/*.txt"))


def archived(spark, folder, limits, trigger=None):
    stream = topics.read_topics(spark, f"{folder}/topics", "json.*", max_files=1)
    return archive_buffered(stream, f"{folder}/out", f"{folder}/ck", limits=limits, tasks=2, trigger=trigger)


def test_small_batches_fill_files_over_restarts(spark, folder):
    put_records(spark, folder, 0, 5)
    finish(archived(spark, folder, Limits(3600, 3)))
    assert file_sizes(folder) == [3]
    put_records(spark, folder, 5, 8)
    finish(archived(spark, folder, Limits(3600, 3)))
    assert file_sizes(folder) == [3, 3]
    finish(archived(spark, folder, Limits(3600, 3)))
    kept = [r.value for r in spark.read.text(f"{folder}/out").collect()]
    assert sorted(kept) == [f'{{"k":{k}}}' for k in range(6)]


def test_a_rest_is_flushed_by_time(spark, folder):
    put_records(spark, folder, 0, 4)
    limits = Limits(12, 3)
    drain(archived(spark, folder, limits, {"processingTime": "0 seconds"}), limits)
    assert file_sizes(folder) == [1, 3]
    assert sorted(r.value for r in spark.read.text(f"{folder}/out").collect()) == [f'{{"k":{k}}}' for k in range(4)]


def test_buffers_by_bytes_hold_any_batch(spark, folder):
    logs.write_stream_log(messages(spark, SF).filter("seq < 400"), f"{folder}/log", 2)
    limits = Limits(1, size=500)
    query = deliver_buffered(read_stream(spark, f"{folder}/log"), f"{folder}/out", f"{folder}/ck", limits, {"processingTime": "0 seconds"})
    drain(query, limits)
    want = messages(spark, SF).filter("seq < 400 and seq % 20 > 4").select("seq")
    found = read_raw(spark, f"{folder}/out", "year string, month string, day string, hour string").select(F.col("trans_id").alias("seq"))
    assert found.count() == want.count() and found.exceptAll(want).isEmpty()


def test_buffered_columns(spark, folder):
    os.makedirs(f"{local(folder)}/in")
    stream = spark.readStream.schema("value string, _hidden string").parquet(f"{folder}/in")
    with pytest.raises(ValueError, match="underscore"):
        buffered(stream, ["value"], Limits(1))


def test_hours_close_once_and_late_trades_count(spark, folder):
    def trade(k, hour, dollars):
        return (1704067200 + 3600 * hour + k, "A", dollars, 1.0, dollars, "buy", k)

    def run(*rows):
        spark.createDataFrame(rows, TRADE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        finish(top_stream(spark.readStream.schema(TRADE).parquet(f"{folder}/in"), f"{folder}/top", f"{folder}/ck", "1 hour"))
        return sorted((r.HourlyBucket[-2:], r.trans_id, r.trades) for r in spark.read.parquet(f"{folder}/top").collect())

    assert run(trade(1, 0, 5.0), trade(2, 0, 7.0), trade(3, 0, 7.0), trade(9, 1, 1.0)) == []
    # Still open: the hour takes a trade that comes behind later ones.
    assert run(trade(4, 0, 6.0), trade(10, 3, 1.0)) == [("00", 2, 4), ("01", 9, 1)]
    assert run(trade(5, 0, 99.0), trade(6, 1, 99.0), (None, "A", 1.0, 1.0, 1.0, "buy", 7)) == [("00", 2, 4), ("01", 9, 1)]
    assert late_trades(spark, 8, f"{folder}/top", f"{folder}/ck") == 2


def test_repeats_are_left_out_within_their_time(spark, folder):
    sent = messages(spark, SF).filter("seq < 60")
    first = sent.agg(F.min("arrival_ts")).first()[0]
    near = sent.filter("seq = 10").withColumn("arrival_ts", F.col("arrival_ts") + F.expr("INTERVAL 5 MINUTES"))
    logs.write_stream_log(sent.unionByName(near), f"{folder}/log", 1)
    stream = once(read_stream(spark, f"{folder}/log"), "30 days")
    finish(start(stream.writeStream.format("parquet"), f"{folder}/out", f"{folder}/ck"))
    assert spark.read.parquet(f"{folder}/out").count() == 60
    finish(*deliver(read_stream(spark, f"{folder}/log"), f"{folder}/raw", f"{folder}/errors", f"{folder}/ck2"))
    assert spark.read.text(f"{folder}/raw").count() + spark.read.json(f"{folder}/errors").count() == 61
    # Ids leave the state once the watermark has passed them.
    later = F.lit(first + timedelta(days=400))
    for row in (messages(spark, SF).filter("seq = 70"), near):
        logs.write_stream_log(row.withColumn("arrival_ts", later), f"{folder}/log", 1)
        stream = once(read_stream(spark, f"{folder}/log"), "30 days")
        query = start(stream.writeStream.format("parquet"), f"{folder}/out", f"{folder}/ck")
        finish(query)
    assert spark.read.parquet(f"{folder}/out").count() == 62
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 2


def test_a_repeated_refine_replaces_its_own_output(spark, folder):
    lines = messages(spark, SF).filter("seq % 20 > 4 and seq < 200")
    lines.filter("seq < 100").select("value").coalesce(1).write.text(f"{folder}/raw/a")
    lines.filter("seq >= 100").select("value").coalesce(1).write.text(f"{folder}/raw/b")
    refine_again(spark, f"{folder}/raw", f"{folder}/out")
    want = refine(parse_raw(lines.select("value")))

    def found():
        return spark.read.parquet(f"{folder}/out")

    def files(part):
        names = {r.f for r in spark.read.text(f"{folder}/raw/{part}").select(F.col("_metadata.file_name").alias("f")).collect()}
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local(folder)}/out/**/*.parquet", recursive=True) if any(n[-30:] in f for n in names)}

    before = files("b")
    refine_again(spark, f"{folder}/raw/a", f"{folder}/out")
    assert found().count() == want.count() == 150 and files("b") == before != {}
    refine_again(spark, [f"{folder}/raw/a", f"{folder}/raw/b"], f"{folder}/out")
    assert found().select("trans_id").exceptAll(want.select("trans_id")).isEmpty() and found().count() == 150


def test_both_zones_out_of_one_check(spark, folder):
    logs.write_stream_log(messages(spark, SF).filter("seq < 200"), f"{folder}/log", 2)

    def run(checkpoint="ck"):
        query = deliver_together(read_stream(spark, f"{folder}/log", max_files=1), f"{folder}/raw", f"{folder}/errors", f"{folder}/{checkpoint}")
        finish(query)
        return spark.read.text(f"{folder}/raw").count(), spark.read.json(f"{folder}/errors").count()

    assert run() == run() == (150, 50)
    # A batch that is repeated, as after a failure before its commit, writes the same again.
    last = max(int(os.path.basename(f)) for f in glob.glob(f"{local(folder)}/ck/commits/[0-9]*"))

    def without_last(where, names):
        return [n for n in names if where.endswith("/commits") and n in (str(last), f".{last}.crc")]

    shutil.copytree(f"{local(folder)}/ck", f"{local(folder)}/ck2", ignore=without_last)
    assert run("ck2") == (150, 50)


def test_landed_records_keep_all_number_rules(spark, folder):
    """Fields of any type come back as the text's own parse gives them, and no text is parsed again."""
    odd = ["1", '"12"', "1.7", "true", '" 3 "', '"1e3"', "1e400", "0.1", "12345678901234567890", '"nan"', "null", "[1]", '{"a":1}', '"x"']
    rows = [(f'{{"transaction_ts": {a}, "symbol": {b}, "price": {b}, "amount": {a}, "dollar_amount": {b}, "type": {a}, "trans_id": {b}, "more": 1}}',) for a in odd for b in odd]
    rows += [('{"symbol": "A", "symbol": "B", "price": 1}',)]
    lines = spark.createDataFrame(rows, "value string")
    lines.coalesce(2).withColumn("record", records.trade_record(records.trade_fields(F.col("value")))).write.parquet(f"{folder}/landed")
    landed = typed_records(spark.read.parquet(f"{folder}/landed").select("record"))
    want = parse_raw(lines)
    assert sorted(map(str, landed.collect())) == sorted(map(str, want.collect()))
    plan = plan_of(landed)
    assert "from_json" not in plan and "value#" not in plan and "from_json" in plan_of(want)


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"), ("void", "date", "date"), ("date", "timestamp", "timestamp"),
        ("decimal(5,2)", "decimal(4,3)", "decimal(6,3)"), ("decimal(38,0)", "decimal(38,10)", "double"), ("decimal(5,2)", "int", "double"), ("boolean", "int", "string"),
        ("array<int>", "array<double>", "array<double>"), ("struct<a:int>", "struct<A:bigint,b:string>", "struct<a:bigint,b:string>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
    ],
)
def test_widening(spark, a, b, both):
    x, y, z = (T.StructType.fromDDL(f"v {kind}")["v"].dataType for kind in (a, b, both))
    assert widened(x, y) == z
    assert widened(y, x).simpleString().lower() == z.simpleString() and widened(x, x) == x
    assert merged(T.StructType([]), T.StructType.fromDDL(f"v {a}")).names == ["v"]


def test_a_second_crawl_opens_new_files_only(spark, folder):
    catalog.recreate_database(spark, "again")
    root, state, name = f"{folder}/raw", f"{folder}/seen", "again.t"

    def put(day, *columns):
        lines = spark.range(20).selectExpr(*columns).select(F.to_json(F.struct("*")).alias("value"))
        lines.coalesce(2).write.mode("append").text(f"{root}/day={day}")

    put("01", "id", "id % 3 AS amount", "named_struct('a', id) AS s", "CAST(NULL AS string) AS gone")
    first = crawl_changes(spark, root, name, state)
    assert first.changed and first.opened == len(glob.glob(f"{local(root)}/*/*.txt"))
    assert crawl_changes(spark, root, name, state).opened == 0
    put("0 2+", "id", "id % 3 AS amount")
    second = crawl_changes(spark, root, name, state)
    assert not second.changed and 0 < second.opened <= 2 and spark.table(name).count() == 40
    assert spark.read.parquet(state).filter("schema IS NULL").isEmpty()
    put("03", "id", "id / 3 AS amount", "named_struct('a', 'x', 'b', true) AS s", "'n' AS note")
    assert crawl_changes(spark, root, name, state).changed
    kinds = dict(spark.table(name).dtypes)
    assert kinds == {"amount": "double", "id": "bigint", "s": "struct<a:string,b:boolean>", "note": "string", "day": "string"}
    assert spark.table(name).count() == 60
    assert spark.table(name).filter("day = '01'").select("s.a").distinct().count() == 20
    spark.createDataFrame([("broken",), ("[1]",)], "value string").coalesce(1).write.mode("append").text(f"{root}/day=03")
    assert not crawl_changes(spark, root, name, state).changed
    spark.range(1).selectExpr("'{}' AS value").write.text(f"{root}/other=1")
    with pytest.raises(ValueError, match="path columns"):
        crawl_changes(spark, root, name, f"{folder}/fresh")
    catalog.recreate_database(spark, "again")


def test_a_crawl_widens_parquet(spark, folder):
    catalog.recreate_database(spark, "again")
    spark.range(5).selectExpr("CAST(id AS int) AS x").write.parquet(f"{folder}/p/day=__HIVE_DEFAULT_PARTITION__")
    assert crawl_changes(spark, f"{folder}/p", "again.p", f"{folder}/seen", "parquet").changed
    spark.range(5).selectExpr("id AS x", "1.5D AS y").write.parquet(f"{folder}/p/day=a%3Ab")
    spark.range(5).selectExpr("CAST(id AS int) AS x").write.parquet(f"{folder}/p/day=c")
    assert crawl_changes(spark, f"{folder}/p", "again.p", f"{folder}/seen", "parquet").changed
    spark.range(5).selectExpr("id AS x").write.parquet(f"{folder}/p/day=it's")
    assert not crawl_changes(spark, f"{folder}/p", "again.p", f"{folder}/seen", "parquet").changed
    rows = spark.table("again.p").groupBy("day").agg(F.sum("x").alias("x"), F.count("y").alias("y")).collect()
    assert sorted(((r.day or ""), r.x, r.y) for r in rows) == [("", 10, 0), ("a:b", 10, 5), ("c", 10, 0), ("it's", 10, 0)]
    with pytest.raises(ValueError, match="csv"):
        crawl_changes(spark, f"{folder}/p", "again.q", f"{folder}/seen2", "csv")
    catalog.recreate_database(spark, "again")


def test_bytes_are_those_of_the_chunks_read(spark, folder):
    rows = trades(spark, SF).select(*TRADE.names, F.struct("price", "amount").alias("pair"))
    rows.orderBy("trans_id").coalesce(1).write.option("parquet.block.size", 4096).option("parquet.page.row.count.limit", 50).parquet(f"{folder}/t")
    about = pq.ParquetFile(glob.glob(f"{local(folder)}/t/*.parquet")[0]).metadata
    names = [about.schema.column(i).path for i in range(about.num_columns)]

    def size(columns, groups):
        return sum(about.row_group(g).column(i).total_compressed_size for g in groups for i, n in enumerate(names) if n.split(".")[0] in columns)

    every = range(about.num_row_groups)
    found = column_bytes(spark, f"{folder}/t", ["price", "pair"]).first()
    assert found.bytes == size({"price", "pair"}, every) and found.rows == 1000
    kept = [g for g in every if about.row_group(g).column(names.index("trans_id")).statistics.max >= 900]
    found = column_bytes(spark, f"{folder}/t", ["price"], "trans_id", low=900).first()
    assert (found.read_groups, found.bytes) == (len(kept), size({"price", "trans_id"}, kept))
    assert column_bytes(spark, f"{folder}/t", ["absent"]).first().bytes == 0


def test_count_reads_no_column(spark, folder):
    trades(spark, SF).write.partitionBy("symbol").parquet(f"{folder}/t")
    counted = count_from_footers(spark, f"{folder}/t")
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().explainString(counted.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert counted.first().rows == 1000
    assert "FileScan parquet" in plan_of(spark.read.parquet(f"{folder}/t"))


def scanned(df):
    """Rows that the scan of a plan put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().get("numOutputRows").get().value()


def test_look_ups_skip_row_groups(spark, folder):
    rows = spark.range(40_000).select(F.concat(F.lit("k"), F.lpad((F.col("id") * 2).cast("string"), 6, "0")).alias("key"), "id")
    write_for_lookup(rows.repartition(8), f"{folder}/t", "key", [], distinct=40_000)
    rows.repartition(8).write.parquet(f"{folder}/plain")
    clustered, plain = (spark.read.parquet(f"{folder}/{name}") for name in ("t", "plain"))
    assert clustered.filter("key = 'k000020'").first().id == 10
    assert scanned(plain.filter("key = 'k000020'")) > 4 * scanned(clustered.filter("key = 'k000020'"))
    # Inside a range of keys, yet not there: the Bloom filter tells.
    assert scanned(clustered.filter("key = 'k000021'")) == 0
