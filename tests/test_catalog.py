"""Databases, tables, partitions, crawls and pruning."""

from __future__ import annotations

import pytest
from conftest import SF, plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.plans.inputs import trades
from tradelake.sources import catalog
from tradelake.sources.avro import avro_schema, has_avro_module, write_avro
from tradelake.sources.files import child_folders, list_files, reset_table


@pytest.fixture
def database(spark, folder):
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    catalog.recreate_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def daily(spark, path, fmt="parquet"):
    rows = trades(spark, SF).selectExpr("trans_id", "price", "int(trans_id % 4) AS month", "int(trans_id % 3) AS day")
    rows.write.partitionBy("month", "day").format(fmt).option("header", True).save(path)
    return rows


def test_partitions_show_up_when_added_or_repaired(spark, folder, database):
    daily(spark, folder)
    name = f"{database}.t"
    catalog.create_table(spark, name, "trans_id bigint, price double", "month int, day int", folder)
    assert spark.table(name).count() == 0
    catalog.add_partition(spark, name, {"month": 1, "day": "2"}, f"{folder}/month=1/day=2")
    catalog.add_partition(spark, name, {"month": 1, "day": 2}, f"{folder}/month=1/day=2")
    assert [r.partition for r in catalog.show_partitions(spark, name).collect()] == ["month=1/day=2"]
    assert spark.table(name).filter("month = 1 AND day = 2").count() == spark.table(name).count() > 0
    catalog.repair(spark, name)
    assert catalog.show_partitions(spark, name).count() == 12
    assert spark.table(name).count() == 1000
    plan = plan_of(spark.table(name).filter("day = '1'").select("price"))
    assert "PartitionFilters: [isnotnull(day" in plan and "ReadSchema: struct<price:double>" in plan


def test_create_replaces_and_recreate_empties(spark, folder, database):
    daily(spark, folder)
    name = f"{database}.t"
    catalog.create_table(spark, name, "trans_id bigint", "month int, day int", folder)
    catalog.create_table(spark, name, "price double", "month int, day int", folder)
    assert spark.table(name).columns == ["price", "month", "day"]
    catalog.recreate_database(spark, database)
    with pytest.raises(AnalysisException):
        spark.table(name)
    catalog.create_zones(spark, {"raw": database, "processed": f"{database}_p"})
    catalog.create_zones(spark, {"raw": database})
    assert spark.catalog.databaseExists(f"{database}_p")
    spark.sql(f"DROP DATABASE {database}_p CASCADE")


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_crawl_finds_format_columns_and_partitions(spark, folder, database, fmt):
    daily(spark, f"{folder}/Year=2024", fmt)
    spark.range(1).write.parquet(f"{folder}/_hidden")
    names = catalog.crawl(spark, folder, database, "zone_")
    assert names == [f"`{database}`.`zone_year_2024`"]
    found = spark.table(names[0])
    assert set(found.columns) == {"trans_id", "price", "month", "day"} and found.count() == 1000
    assert dict(found.dtypes)["month"] == "string"
    trades(spark, SF).selectExpr("trans_id", "price", "'07' AS month", "'01' AS day").write.mode(
        "append"
    ).partitionBy("month", "day").format(fmt).option("header", True).save(f"{folder}/Year=2024")
    assert catalog.crawl(spark, folder, database, "zone_") == names
    assert spark.table(names[0]).count() == 2000
    assert spark.table(names[0]).filter("month = '07'").count() == 1000


def test_crawl_of_a_whole_root(spark, folder, database):
    daily(spark, folder)
    names = catalog.crawl(spark, folder, database, "stock_", table="data")
    assert names == [f"`{database}`.`stock_data`"]
    assert spark.table(names[0]).count() == 1000
    assert child_folders(spark, folder) == ["month=0", "month=1", "month=2", "month=3"]
    spark.range(3).selectExpr("id AS trans_id", "1D AS price", "'x' AS note").write.mode("append").parquet(
        f"{folder}/month=0/day=0"
    )
    assert "note" not in spark.table(names[0]).columns
    catalog.crawl(spark, folder, database, "stock_", table="data", refresh=True)
    assert spark.table(names[0]).count() == 1003


def test_avro_tables_are_views_without_the_module(spark, folder, database):
    schema = avro_schema(T.StructType([T.StructField("id", T.LongType(), False)]), "Rows")
    rows = spark.range(20).selectExpr("id", "int(id % 2) AS day")
    write_avro(rows, f"{folder}/rows", schema, ["day"])
    catalog.create_table(spark, f"{database}.av", "id bigint", "day int", f"{folder}/rows", "avro")
    found = spark.table("av") if not has_avro_module(spark) else spark.table(f"{database}.av")
    assert found.filter("day = 1").count() == 10 or has_avro_module(spark)


def test_reset_removes_table_and_files(spark, folder, database):
    daily(spark, folder)
    name = f"{database}.t"
    catalog.create_table(spark, name, "price double", "month int, day int", folder)
    assert list_files(spark, folder, "*.parquet").count() >= 12
    reset_table(spark, name, folder)
    assert not spark.catalog.tableExists(name)
    with pytest.raises(AnalysisException):
        list_files(spark, folder)


def test_crawl_of_plain_files_and_of_clashing_names(spark, folder, database):
    spark.range(4).write.parquet(f"{folder}/plain")
    names = catalog.crawl(spark, f"{folder}/plain", database)
    assert names == [f"`{database}`.`plain`"] and spark.table(names[0]).count() == 4
    for name in ("a-b", "a_b"):
        spark.range(1).write.parquet(f"{folder}/two/{name}")
    with pytest.raises(ValueError, match="a_b"):
        catalog.crawl(spark, f"{folder}/two", database)


def test_quotes_in_values_and_paths(spark, folder, database):
    path = f"{folder}/it's"
    spark.range(2).withColumn("who", F.lit("o'b")).write.partitionBy("who").parquet(path)
    catalog.create_table(spark, f"{database}.q", "id bigint", "who string", path)
    catalog.add_partition(spark, f"{database}.q", {"who": "o'b"}, f"{path}/who=o%27b")
    assert spark.table(f"{database}.q").filter(F.col("who") == "o'b").count() == 2
