"""Archives of many small files: names in a list, files opened by tasks."""

from __future__ import annotations

import glob
import os
from datetime import datetime, timezone

from tradelake.sources import topics
from tradelake.streaming.archive import archive_topics, read_archive
from tradelake.streaming.queries import finish
from tradelake.streaming.small_files import folder_of, opened, read_small_files, values_of, write_batch

RECORD = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"


def put(spark, folder, records):
    at = datetime(2024, 1, 1, 5, tzinfo=timezone.utc)
    rows = [(topic, 0, k, at, None, value) for k, (topic, value) in enumerate(records)]
    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(f"{folder}/topics")


def archive(spark, folder):
    stream = topics.read_topics(spark, f"{folder}/topics", "(?s).*")
    finish(archive_topics(stream, f"{folder}/out", f"{folder}/ck", hourly=True))
    return read_archive(spark, f"{folder}/out", hourly=True)


def test_files_without_checksums_or_the_sinks_log(spark, folder):
    # Hadoop's writer leaves a checksum file and starts a process for each file; names went through the driver.
    put(spark, folder, [("json.a", f"v{k}".encode()) for k in range(25)])
    found = archive(spark, folder)
    base = folder.removeprefix("file:")
    files = glob.glob(f"{base}/out/topic=json.a/year=2024/month=1/day=1/hour=5/*")
    assert sorted(len(open(f).read().split()) for f in files) == [5, 10, 10]
    assert not glob.glob(f"{base}/out/topic=json.a/**/.*.crc", recursive=True)
    assert not os.path.exists(f"{base}/out/_spark_metadata")
    assert sorted(r.value for r in found.collect()) == sorted(f"v{k}" for k in range(25))
    assert spark.read.text(f"{folder}/out").count() == 25


def test_odd_topics_and_values_come_back(spark, folder):
    names = ["a/b=c%", "a b", "ä:*?", "x\n", "plain"]
    put(spark, folder, [(n, v) for n in names for v in ("ü\t".encode(), b"", None)])
    found = archive(spark, folder)
    want = sorted((n, v) for n in names for v in ("ü\t", "", "null"))
    assert sorted((r.topic, r.value) for r in found.collect()) == want
    # Spark's own reader finds the same in the folders.
    assert sorted((r.topic, r.value) for r in spark.read.text(f"{folder}/out").collect()) == want


def test_local_paths_are_taken_as_they_are():
    assert opened("file:///tmp/a b%20#c")[1] == "/tmp/a b%20#c"


def test_missing_values_have_a_folder():
    file = folder_of(["a", "b", "c"], (None, "", "1")) + "/part"
    assert file == "a=__HIVE_DEFAULT_PARTITION__/b=__HIVE_DEFAULT_PARTITION__/c=1/part"
    assert values_of(file) == [None, None, "1"]


def test_a_batch_again_replaces_its_files(spark, folder):
    def write(n, batch):
        rows = spark.createDataFrame([("t", f"v{k}") for k in range(n)], "topic string, value string")
        write_batch(rows.coalesce(1), batch, f"{folder}/out", ["topic"], 10)

    write(35, 0)
    write(12, 1)
    write(8, 0)
    for found in (read_small_files(spark, f"{folder}/out", ["topic"]), spark.read.text(f"{folder}/out")):
        assert found.count() == 20
    assert read_small_files(spark, f"{folder}/none", ["topic"]).count() == 0
