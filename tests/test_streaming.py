"""Streams: delivery, refining, start positions, restarts and archives."""

from __future__ import annotations

import glob
from datetime import datetime, timezone

import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F

from tradelake.operators.trades import refine
from tradelake.operators.validation import route
from tradelake.plans.inputs import messages, topic_records
from tradelake.sources import log as logs
from tradelake.sources import topics
from tradelake.sources.trades import parse_raw, read_processed, read_raw
from tradelake.streaming.archive import archive_lines, archive_topics
from tradelake.streaming.delivery import deliver
from tradelake.streaming.log import LATEST, read_stream
from tradelake.streaming.queries import BatchCounter, display, finish, start
from tradelake.streaming.refining import refine_stream, reject_stream

FEW = "seq < 120"


def few(spark):
    return messages(spark, SF).filter(FEW)


def copy(stream, folder):
    with BatchCounter(stream.sparkSession) as counter:
        query = start(stream.writeStream.format("parquet"), f"{folder}/out", f"{folder}/ck")
        finish(query)
        counts = counter.counts(query)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out"), counts


def test_one_key_stays_in_one_shard_of_several_files(spark, folder):
    logs.write_stream_log(few(spark), folder, 3)
    logs.write_stream_log(messages(spark, SF).filter("seq between 120 and 199"), folder, 3)
    log = logs.read_log(spark, folder)
    assert log.count() == 200
    assert log.groupBy("partition_key").agg(F.countDistinct("shard").alias("n")).filter("n > 1").isEmpty()
    assert log.filter("shard < 0 or shard > 2").isEmpty()
    assert log.filter("partition_key = 'invalid'").count() == 20


def test_every_shard_number_is_used(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    counts = keys.groupBy(logs.shard_of(F.col("k"), 8).alias("s")).count().collect()
    assert sorted(r.s for r in counts) == list(range(8))
    assert all(80 < r["count"] < 170 for r in counts)


def test_pages_of_a_shard_join_up(spark, folder):
    logs.write_stream_log(few(spark), folder, 2)
    log = logs.read_log(spark, folder)
    whole = [r.seq for r in log.filter("shard = 1").orderBy("seq").collect()]
    read, last = [], None
    while page := logs.read_page(log, 1, last, 7).collect():
        read, last = read + [r.seq for r in page], page[-1].position
    assert read == whole and len(whole) > 14
    plan = plan_of(logs.read_page(log, 1, 50, 7))
    assert "TakeOrderedAndProject" in plan and "GreaterThan(position,50)" in plan
    assert "PartitionFilters: [isnotnull(shard" in plan


def test_pipeline_from_log_to_processed(spark, folder):
    """The stream run agrees with the batch steps, and a restart adds nothing."""
    logs.write_stream_log(few(spark), f"{folder}/log", 2)

    def run():
        stream = read_stream(spark, f"{folder}/log", max_files=1)
        finish(*deliver(stream, f"{folder}/raw", f"{folder}/errors", f"{folder}/ck"))
        finish(refine_stream(spark, f"{folder}/raw", f"{folder}/processed", f"{folder}/ck-refine"))

    def processed():
        return read_processed(spark, f"{folder}/processed")

    run()
    good, failed = route(logs.read_log(spark, f"{folder}/log"))
    want = refine(parse_raw(good.select("value")))
    assert processed().exceptAll(want.select(*processed().columns)).isEmpty()
    assert processed().count() == want.count() == 90
    assert spark.read.json(f"{folder}/errors").count() == failed.count() == 30
    run()
    assert processed().count() == 90
    logs.write_stream_log(messages(spark, SF).filter("seq between 120 and 139"), f"{folder}/log", 2)
    run()
    assert processed().count() == 105
    assert spark.read.json(f"{folder}/errors").count() == 35


def test_records_with_one_number_stay_apart(spark, folder):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(n, "k", at, f"v{i}") for i, n in enumerate([1, 2, 3, 4, 4, 4])]
    sent = spark.createDataFrame(rows, "seq bigint, partition_key string, arrival_ts timestamp, value string")
    logs.write_stream_log(sent, f"{folder}/log", 1)
    log = logs.read_log(spark, f"{folder}/log")
    first = logs.read_page(log, 0, None, 4).collect()
    second = logs.read_page(log, 0, first[-1].position, 4).collect()
    assert [r.seq for r in first + second] == [1, 2, 3, 4, 4, 4]
    stream = read_stream(spark, f"{folder}/log", LATEST, checkpoint=f"{folder}/ck")
    logs.write_stream_log(sent.withColumn("seq", F.col("seq") - 1), f"{folder}/log", 1)
    seen, _ = copy(stream.select("seq"), folder)
    assert sorted(r.seq for r in seen.collect()) == [0, 1, 2, 3, 3, 3]


def test_rejected_lines_are_counted_and_kept(spark, folder):
    good = '{"transaction_ts": 1704067199, "symbol": "A", "price": 1.0, "amount": 1.0, "dollar_amount": 1.0, "type": "buy", "trans_id": 1}'
    spark.createDataFrame([(good,), ("broken {",), (good.replace("symbol", "sign"),)], "value string").coalesce(1).write.text(f"{folder}/raw")
    query = refine_stream(spark, f"{folder}/raw", f"{folder}/processed", f"{folder}/ck")
    finish(query, reject_stream(spark, f"{folder}/raw", f"{folder}/errors", f"{folder}/ck2"))
    counted = [p["observedMetrics"]["refining"] for p in query.recentProgress if p["observedMetrics"].get("refining")]
    assert [(c["lines"], c["rejected"]) for c in counted] == [(3, 2)]
    assert read_processed(spark, f"{folder}/processed").count() == 1
    assert {r.raw_line for r in spark.read.json(f"{folder}/errors").collect()} == {"broken {", good.replace("symbol", "sign")}


def test_archived_values_stay_one_line(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [("t", at, b'{"a":\r\n1}'), ("t", at, None)]
    lines = archive_lines(spark.createDataFrame(rows, "topic string, timestamp timestamp, value binary"))
    assert [r.value for r in lines.collect()] == ['{"a": 1}', "null"]


def test_zone_paths_and_late_records(spark, folder):
    """Raw lies under the padded arrival hour, processed under the plain event hour."""
    value = (
        '{"transaction_ts": 1704067199, "symbol": "A", "price": 1.0, "amount": 1.0,'
        '\n "dollar_amount": 1.0, "type": "buy", "trans_id": 1}'
    )
    arrival = datetime(2024, 2, 3, 4, 5, tzinfo=timezone.utc)
    rows = [(1, "A", arrival, value), (2, "A", arrival, "bad")]
    sent = spark.createDataFrame(rows, "seq bigint, partition_key string, arrival_ts timestamp, value string")
    logs.write_stream_log(sent, f"{folder}/log", 1)
    finish(*deliver(read_stream(spark, f"{folder}/log"), f"{folder}/raw", f"{folder}/errors", f"{folder}/ck"))
    finish(refine_stream(spark, f"{folder}/raw", f"{folder}/processed", f"{folder}/ck2"))
    base = folder.removeprefix("file:")
    assert glob.glob(f"{base}/raw/year=2024/month=02/day=03/hour=04/*.txt")
    assert glob.glob(f"{base}/errors/type=processing-failed/year=2024/month=02/day=03/*.json")
    assert glob.glob(f"{base}/processed/symbol=A/year=2023/month=12/day=31/hour=23/*.snappy.parquet")
    assert read_raw(spark, f"{folder}/raw").first().trans_id == 1


def test_start_positions(spark, folder):
    log = f"{folder}/log"
    logs.write_stream_log(few(spark), log, 2)
    with pytest.raises(ValueError, match="checkpoint"):
        read_stream(spark, log, LATEST)
    ck = f"{folder}/latest/ck"
    read_stream(spark, log, LATEST, checkpoint=ck)
    logs.write_stream_log(messages(spark, SF).filter("seq between 120 and 149"), log, 2)
    # Opened again after the append, the first position still holds.
    seen, _ = copy(read_stream(spark, log, LATEST, checkpoint=ck).select("seq"), f"{folder}/latest")
    assert seen.agg(F.min("seq"), F.count("*")).first() == (120, 30)
    ends = logs.last_positions(logs.read_log(spark, log))
    behind, _ = copy(read_stream(spark, log, {0: ends[0], 1: ends[1] - 1}).select("seq", "shard", "position"), f"{folder}/behind")
    assert [(r.shard, r.position) for r in behind.collect()] == [(1, ends[1])]
    moment = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    late, _ = copy(read_stream(spark, log, moment).select("arrival_ts"), f"{folder}/time")
    want = logs.read_log(spark, log).filter(F.col("arrival_ts") >= F.lit(moment)).count()
    assert late.count() == want > 0


def test_batches_are_limited_and_counted(spark, folder):
    logs.write_stream_log(few(spark), f"{folder}/log", 3)
    _, counted = copy(read_stream(spark, f"{folder}/log", max_files=1).select("seq"), f"{folder}/files")
    counts = [n for _, n in counted]
    assert len(counts) >= 3 and sum(counts) == 120
    _, counted = copy(read_stream(spark, f"{folder}/log", max_bytes=1).select("seq"), f"{folder}/bytes")
    assert len(counted) >= 3


def test_archive_limits_rows_per_file(spark, folder):
    topic_records(spark, SF).filter("offset < 60").write.parquet(f"{folder}/topics")
    stream = topics.read_topics(spark, f"{folder}/topics", "json.*")
    finish(archive_topics(stream, f"{folder}/json", f"{folder}/ck"))
    stored = spark.read.text(f"{folder}/json").withColumn("f", F.input_file_name())
    sizes = [r["count"] for r in stored.groupBy("f").count().collect()]
    assert max(sizes) == 10
    assert sum(sizes) == topic_records(spark, SF).filter("offset < 60 and topic like 'json%'").count()
    base = folder.removeprefix("file:")
    assert glob.glob(f"{base}/json/topic=json.view/year=2024/month=1/day=1/*.txt")
    assert not glob.glob(f"{base}/json/topic=raw.error")


def test_archive_by_hour_with_a_number_of_tasks(spark, folder):
    topic_records(spark, SF).filter("offset < 60").write.parquet(f"{folder}/topics")
    stream = topics.read_topics(spark, f"{folder}/topics", ".*").transform(topics.archive_transform)
    finish(archive_topics(stream, f"{folder}/all", f"{folder}/ck", hourly=True, tasks=3))
    base = folder.removeprefix("file:")
    files = glob.glob(f"{base}/all/topic=*/year=2024/month=1/day=*/hour=*/part-*.txt")
    assert {f.rsplit("/part-", 1)[1][:5] for f in files} <= {"00000", "00001", "00002"}
    assert spark.read.text(f"{folder}/all").count() == 60


def test_topic_patterns_match_whole_names(spark):
    names = ["json", "json.a", "xjson.a", "json.a\n"]
    frame = spark.createDataFrame([(n,) for n in names], "topic string")
    assert {r.topic for r in topics.matching(frame, "json.*").collect()} == {"json", "json.a"}
    assert topics.matching(frame.filter("topic <> 'json.a\n'"), ".*").count() == 3


def test_archive_transform_order(spark):
    when = datetime(2024, 1, 1, 0, 0, 1, 999_999, tzinfo=timezone.utc)
    rows = [("t", 2, 5, when, None, bytearray(b'{"k": 69}'))]
    frame = spark.createDataFrame(
        rows, "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"
    )
    assert topics.archive_transform(frame).first().value == (
        '{"msg_payload":"eyJrIjogNjl9","msg_partition":2,"msg_offset":5,"msg_ts":1704067201999}'
    )


def test_streams_run_adaptively(spark, folder, capsys):
    """The rebalance before a stream's sink relies on it."""
    logs.write_stream_log(few(spark), f"{folder}/log", 2)
    raw, errors = deliver(
        read_stream(spark, f"{folder}/log"), f"{folder}/raw", f"{folder}/errors", f"{folder}/ck"
    )
    finish(raw, errors)
    capsys.readouterr()
    raw.explain()
    plan = capsys.readouterr().out
    assert "AdaptiveSparkPlan isFinalPlan=true" in plan and "ShuffleQueryStage" in plan
    assert plan.count("from_json(") in (1, 2)  # one per plan shown


def test_display(spark, folder):
    logs.write_stream_log(few(spark), f"{folder}/log", 2)
    with BatchCounter(spark) as counter:
        query = display(read_stream(spark, f"{folder}/log"), f"{folder}/ck")
        finish(query)
        assert sum(n for _, n in counter.counts(query)) == 120
