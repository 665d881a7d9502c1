"""Lookups, nested fields, unnesting and plain aggregates."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import CUSTOMER_PARTITIONS
from tradelake.sources.customers import EVENT, parquet_event, read_customers
from tradelake.sources.files import list_files
from tradelake.sources.footers import column_bytes, total_bytes


def with_extras(df: DataFrame, *expressions: str) -> DataFrame:
    """Every column plus further SQL expressions; names are matched in any case."""
    return df.selectExpr("*", *expressions)


def unnest(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per array element; a null or empty array gives none."""
    return df.select("*", F.explode(array).alias(name))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def avg_by(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """Average of a column over the rows a condition picks."""
    picked = df.filter(where) if where else df
    return picked.agg(F.avg(column).alias(f"avg_{column}"))


def compare_scan(
    spark: SparkSession, avro_root: str, parquet_root: str, column: str, where: dict[str, object]
) -> DataFrame:
    """The same average on both formats: result, rows, bytes read, seconds.

    A row format is read whole; of Parquet only the column's chunks in the picked folders.
    """
    condition = F.lit(True)
    for name, value in where.items():
        condition = condition & (F.col(name) == F.lit(value))
    folders = "/".join(f"{name}={where.get(name, '*')}" for name in CUSTOMER_PARTITIONS)
    parquet = f"{parquet_root}/{parquet_event()}"
    cases = {
        "avro": (read_customers(spark, avro_root, where), f"{avro_root}/{EVENT}", "*.avro"),
        "parquet": (spark.read.parquet(parquet), parquet, "*.parquet"),
    }
    rows = []
    for name, (data, path, glob) in cases.items():
        if name == "parquet":
            size = total_bytes(column_bytes(spark, f"{path}/{folders}", [column]))
        else:
            size = list_files(spark, f"{path}/{folders}", glob).agg(F.sum("length")).first()[0]
        began = time.monotonic()
        result = data.filter(condition).agg(F.avg(column), F.count("*")).first()
        rows.append((name, result[0], result[1], size, time.monotonic() - began))
    return spark.createDataFrame(
        rows, f"format string, avg_{column} double, rows bigint, bytes bigint, seconds double"
    )
