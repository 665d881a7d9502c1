"""CSV input, coercion, event-time columns, paths and summaries."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import SF, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradelake.functions import text, times
from tradelake.operators import trades as ops
from tradelake.operators.messages import repeat_record
from tradelake.plans.inputs import trades
from tradelake.schemas import TRADE
from tradelake.sources.files import delete_prefix, export_result, with_source_path
from tradelake.sources.log import kafka_columns, trade_messages
from tradelake.sources.trades import read_processed, read_trades_csv, write_processed

HEADER = "trans_id,symbol,price,amount,dollar_amount,type,transaction_ts"


def csv(spark, folder, *lines):
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(folder)
    return read_trades_csv(spark, folder)


def test_csv_columns_go_by_header_and_stay_text(spark, folder):
    frame = csv(spark, folder, HEADER, "1,A,2.5,1,2.5,buy,1704067200")
    assert frame.dtypes == [(name, "string") for name in TRADE.names]
    assert frame.first().transaction_ts == "1704067200"


def test_rows_that_do_not_convert_are_errors(spark, folder):
    frame = csv(
        spark,
        folder,
        HEADER,
        "1,A,2.5,1,2.5,buy,1704067200",
        " 2 ,B,1e1,+1,-inf,sell,1704067200",
        "3,A,x,1,1,buy,1704067200",
        "4.5,A,1,1,1,buy,1704067200",
        "5,A,1,1,1,buy,",
        "6,A,1d,1,1,buy,1704067200",
    )
    typed, errors = ops.coerce_trades(frame)
    assert [(r.trans_id, r.price) for r in typed.orderBy("trans_id").collect()] == [(1, 2.5), (2, 10.0)]
    assert sorted(r.trans_id for r in errors.collect()) == ["3", "4.5", "5", "6"]
    assert typed.schema.simpleString() == TRADE.simpleString()
    summary = ops.delivery_summary(frame).first()
    assert (summary.sent, summary.errors, len(summary.events_sample)) == (2, 4, 2)
    assert summary.events_sample[0].startswith('{"transaction_ts":1704067200,"symbol":"A"')
    report = ops.deliver_counted(frame, lambda df: df.write.parquet(f"{folder}-out"))
    assert (report["sent"], report["errors"]) == (2, 4) and report["rate"] > 0
    assert spark.read.parquet(f"{folder}-out").count() == 2 == ops.delivered_ids(typed).count()


def test_an_empty_file_gives_zero_counts(spark, folder):
    spark.createDataFrame([], "value string").coalesce(1).write.text(folder)
    summary = ops.delivery_summary(read_trades_csv(spark, folder)).first()
    assert (summary.sent, summary.errors, summary.events_sample) == (0, 0, [])


def test_missing_columns_are_named(spark, folder):
    with pytest.raises(ValueError, match="symbol"):
        csv(spark, folder, "trans_id,price", "1,2")


def test_times(spark):
    ts = F.timestamp_seconds(F.lit(1704092709))  # 2024-01-01T07:05:09Z
    row = spark.range(1).select(
        times.iso_text(ts).alias("iso"),
        times.hour_text(ts).alias("hour"),
        times.year_text(ts).alias("year"),
        F.array(*times.padded_parts(ts).values()).alias("padded"),
        F.array(*times.plain_parts(ts).values()).alias("plain"),
        F.array(*times.number_parts(ts).values()).alias("numbers"),
        F.array(*times.padded_parts(ts, last="day").values()).alias("days"),
    ).first()
    assert row.iso == "2024-01-01T07:05:09Z" and row.hour == "2024-01-01T07" and row.year == "2024"
    assert row.padded == ["2024", "01", "01", "07"] and row.plain == ["2024", "1", "1", "7"]
    assert row.numbers == [2024, 1, 1, 7] and row.days == ["2024", "01", "01"]


def test_times_out_of_range_are_left_out_and_counted(spark):
    rows = [(0, "A"), (10**17, "A"), (-(10**17), "A"), (None, "A"), (0, None)]
    frame = spark.createDataFrame(rows, "transaction_ts bigint, symbol string").selectExpr(
        "*", "1D price", "1D amount", "1D dollar_amount", "'buy' type", "1L trans_id"
    )
    assert ops.refine(frame).count() == 1
    assert ops.unrefined(frame).first().dropped == 4


def test_processed_zone(spark, folder):
    refined = ops.refine(trades(spark, SF).filter("trans_id < 100"))
    write_processed(refined, folder)
    write_processed(ops.refine(trades(spark, SF).filter("trans_id between 100 and 149")), folder)
    back = read_processed(spark, folder)
    want = ops.refine(trades(spark, SF).filter("trans_id < 150"))
    assert back.count() == 150 and back.exceptAll(want.select(*back.columns)).isEmpty()
    one = back.filter("symbol = 'SYM_3' AND hour = 5").select("price")
    assert "PartitionFilters: [isnotnull(symbol" in plan_of(one)
    assert "ReadSchema: struct<price:double>" in plan_of(one)
    paths = {r.path for r in ops.partition_paths(want, folder).collect()}
    files = with_source_path(back).select(text.folder_name(F.col("path")).alias("p")).distinct()
    assert {r.p.removeprefix("file://").removeprefix("file:") for r in files.collect()} == paths
    assert all("month=1/" in p and "/day=0" not in p for p in paths)


def test_object_keys(spark):
    keys = ["a%20b/c%2Fd+e%", "x/" + "0" * 10 + "1" * 36, "%zz/%C3%A9"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(
        text.decode_key(F.col("k")).alias("key"), text.output_id(F.col("k")).alias("id")
    ).collect()
    assert [r.key for r in got] == ["a b/c/d+e%", keys[1], "%zz/é"]
    assert got[1].id == "1" * 36 and got[0].id == "c%2Fd+e%"


def test_decimal_from_bytes(spark):
    values = ["0", "1.0000", "-0.0001", "-1.2800", "0.0127", "0.0128", "9999999999999999.9999", "-9999999999999999.9999"]
    rows = []
    for value in values:
        number = int(Decimal(value).scaleb(4))
        rows.append((value, bytearray(number.to_bytes(number.bit_length() // 8 + 1, "big", signed=True))))
    frame = spark.createDataFrame([*rows, ("null", None), ("0", bytearray())], "v string, b binary")
    got = frame.select("v", text.decimal_from_bytes(F.col("b"), 20, 4).alias("d")).collect()
    assert [r.d for r in got] == [Decimal(r.v) if r.v != "null" else None for r in got]


def test_display_line(spark):
    frame = spark.createDataFrame([('{"trans_id": 1, "price": 2.0, "symbol": null}',)], "value string")
    row = ops.format_events(frame).first()
    assert row.line == "Event: trans_id=1 symbol=None price=2.0 amount=None type=None"
    assert row.full_event.startswith('Full event: {"trans_id"')


def test_export_keeps_null_and_empty_text(spark, folder):
    rows = [(1, None), (2, ""), (3, "x")]
    export_result(spark.createDataFrame(rows, "a int, b string"), folder)
    lines = {r.value for r in spark.read.text(folder).collect()}
    assert lines == {"a,b", "1,", '2,""', "3,x"}


def test_deletion_stays_inside_the_root(spark, folder):
    spark.range(1).write.parquet(f"{folder}/a")
    with pytest.raises(ValueError):
        delete_prefix(spark, f"{folder}/../..", root=folder)
    with pytest.raises(ValueError):
        delete_prefix(spark, folder, root=folder)
    with pytest.raises(ValueError):
        delete_prefix(spark, f"{folder}-other", root=folder)
    assert delete_prefix(spark, f"{folder}/a", root=folder)
    assert not delete_prefix(spark, f"{folder}/a", root=folder)


def test_messages(spark):
    frame = trade_messages(trades(spark, SF))
    pair = kafka_columns(frame).first()
    assert pair.key.startswith(b"SYM_") and pair.value.startswith(b'{"transaction_ts":')
    record = spark.createDataFrame([("x",), ("y",)], "value string").coalesce(1)
    assert repeat_record(record, 10_000).agg(F.count("*"), F.countDistinct("value")).first() == (10_000, 1)


def test_a_hot_partition_is_split_and_stays_whole(spark, folder):
    """A third of all rows belong to one hour of one symbol."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)
    rows = spark.range(0, 60_000, 1, 12).select(
        (1704067200 + key * 3600).cast("bigint").alias("transaction_ts"),
        F.lit("HOT").alias("symbol"),
        *[F.rand(1).alias(name) for name in ("price", "amount", "dollar_amount")],
        F.lit("buy").alias("type"),
        F.col("id").alias("trans_id"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "128KB")
    try:
        write_processed(ops.refine(rows), folder)
    finally:
        spark.conf.unset(size)
    back = read_processed(spark, folder)
    assert back.agg(F.countDistinct("trans_id"), F.count("*")).first() == (60_000, 60_000)
    hot = back.filter("day = 1 and hour = 0").select("trans_id", F.input_file_name().alias("f"))
    assert hot.select("f").distinct().count() > 2
    assert back.filter("day = 1 and hour = 7").select(F.input_file_name()).distinct().count() <= 2


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(times.FIRST_SECOND, times.LAST_SECOND), min_size=1, max_size=30))
def test_partition_values_match_the_time(spark, seconds):
    frame = spark.createDataFrame([(s,) for s in seconds], "transaction_ts bigint").selectExpr(
        "*", "'A' symbol", "1D price", "1D amount", "1D dollar_amount", "'buy' type", "transaction_ts trans_id"
    )
    start = datetime(1970, 1, 1)
    for row in ops.refine(frame).collect():
        when = start + timedelta(seconds=row.trans_id)
        assert (row.year, row.month, row.day, row.hour) == (when.year, when.month, when.day, when.hour)
        assert row.transaction_date == f"{when.isoformat()}Z"
    assert ops.refine(frame).count() == len(seconds)


def test_csv_quotes_and_header_order(spark, folder):
    import os

    base = folder.removeprefix("file:")
    os.makedirs(base)
    head = "transaction_ts,symbol,price,amount,dollar_amount,type,trans_id"
    with open(f"{base}/a.csv", "w") as out:
        out.write(head + '\n1,"A ""B"", C",2.0,3.0,6.0,"x\\",4\n')
    row = read_trades_csv(spark, folder).first()
    assert (row.symbol, row.type, row.trans_id) == ('A "B", C', "x\\", "4")
    with open(f"{base}/b.csv", "w") as out:
        out.write(head.replace("price,amount", "amount,price") + "\n1,A,10.0,2.0,20.0,buy,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_trades_csv(spark, folder).collect()
