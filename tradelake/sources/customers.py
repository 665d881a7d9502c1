"""Nested customer records: builder, Avro data set, Parquet conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import CUSTOMER, CUSTOMER_PARTITIONS, PAYMENT_TYPES
from tradelake.sources.avro import avro_schema, read_avro, write_avro

EVENT = "CustomerSnapshot"
NAMESPACE = "org.example.lake.v1"
VERSION = "1.0.0"
PARTITION_DDL = "namespace string, year int, month int, day int, version string"

CUSTOMER_AVRO = avro_schema(
    CUSTOMER, EVENT, NAMESPACE, {"lake-meta": {"version": VERSION, "kind": "snapshot"}}
)

# The parameters every record carries.
PARAMETERS = {"key1": "value1", "key2": "value2"}


def payment(counterparty: Column, grouping: Column, kind: Column, account: Column) -> Column:
    """A payment struct; payee and message stay null."""
    return F.struct(
        counterparty.alias("counterPartyName"),
        grouping.alias("groupingId"),
        F.lit(None).cast("string").alias("payeeId"),
        F.lit(None).cast("string").alias("message"),
        checked_enum(kind, PAYMENT_TYPES).alias("type"),
        account.alias("otherAccountId"),
    )


def checked_enum(value: Column, names: list[str]) -> Column:
    """The value, or an error for one that is not among the names."""
    wrong = F.concat(F.lit("not an enum name: "), F.coalesce(value, F.lit("null")))
    return F.when(value.isin(names), value).otherwise(F.raise_error(wrong).cast("string"))


def parameters() -> Column:
    return F.create_map(*[F.lit(text) for pair in PARAMETERS.items() for text in pair])


def dated(df: DataFrame, year: int, month: int, day: Column) -> DataFrame:
    """Add the partition columns of the customer data set."""
    return df.withColumns(
        {
            "namespace": F.lit(NAMESPACE),
            "year": F.lit(year),
            "month": F.lit(month),
            "day": day.cast("int"),
            "version": F.lit(VERSION),
        }
    )


def customers(spark: SparkSession, n: int = 10_000, seed: int = 0, days: int = 10) -> DataFrame:
    """``n`` made-up customers by id and seed, the same ones on each of ``days`` days."""
    return customers_of(spark.range(n), seed, days)


def customers_of(ids: DataFrame, seed: int = 0, days: int = 10) -> DataFrame:
    """A made-up customer for each ``id``, the same ones on each of ``days`` days.

    Every value is a hash of seed, id and column, so any task repeats exactly.
    """

    def draw(column: str, below: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(column), F.col("id")), F.lit(below))

    def name_id(column: str) -> Column:
        text = F.md5(F.concat_ws(":", F.lit(seed), F.lit(column), F.col("id")).cast("binary"))
        return F.regexp_replace(text, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")

    names = F.transform(
        F.sequence(F.lit(1), (draw("count", 5) + 1).cast("int")),
        lambda i: F.concat(F.lit("n"), F.pmod(F.xxhash64(F.lit(seed), F.col("id"), i), F.lit(1000)).cast("string")),
    )
    whole = 2 * 10**12
    cents = (draw("account", whole) - whole // 2).cast("decimal(20,0)")
    rows = ids.select(
        name_id("customer").alias("customerId"),
        (draw("active", 2) == 0).alias("isActive"),
        (draw("age", 51) + 20).cast("int").alias("age"),
        (draw("balance", 123_000) / 1000).cast("float").alias("balance"),
        (cents * F.lit(0.0001).cast("decimal(4,4)")).cast("decimal(20,4)").alias("accountBalance_logical_dec"),
        names.alias("array_of_strings"),
        payment(name_id("customer"), name_id("group"), F.lit("ONE"), name_id("other")).alias("paymentDetails"),
        parameters().alias("parameters"),
    )
    day = F.explode(F.sequence(F.lit(1), F.lit(days))).alias("_day")
    return dated(rows.select("*", day), 2020, 2, F.col("_day")).drop("_day")


def write_customers(df: DataFrame, root: str, codec: str = "null") -> None:
    """Write the Avro data set under ``root/<event>/namespace=/year=/month=/day=/version=``."""
    write_avro(df, f"{root}/{EVENT}", CUSTOMER_AVRO, CUSTOMER_PARTITIONS, codec)


def read_customers(spark: SparkSession, root: str, where: dict | None = None) -> DataFrame:
    return read_avro(spark, f"{root}/{EVENT}", PARTITION_DDL, where)


def reconcile(df: DataFrame, profile: str = "avro") -> DataFrame:
    """Customer columns in one of two type profiles.

    ``avro`` keeps the source types. ``flat`` gives the types of the registered
    Parquet table: wider numbers, a narrower decimal, the map as a struct, the
    payment fields by name, and the two always-null texts as integers.
    """
    if profile == "avro":
        return df
    if profile != "flat":
        raise ValueError(f"unknown profile {profile}")
    paid = F.col("paymentDetails")
    texts = ["counterPartyName", "groupingId", "message", "otherAccountId", "payeeId", "type"]
    fields = [
        (paid[name].try_cast("int") if name in ("message", "payeeId") else paid[name]).alias(name)
        for name in texts
    ]
    given = F.col("parameters")
    return df.withColumns(
        {
            "age": F.col("age").cast("bigint"),
            "balance": F.col("balance").cast("double"),
            "accountBalance_logical_dec": F.col("accountBalance_logical_dec").cast("decimal(12,4)"),
            "paymentDetails": F.when(paid.isNotNull(), F.struct(*fields)),
            "parameters": F.when(
                given.isNotNull(), F.struct(*[F.try_element_at(given, F.lit(k)).alias(k) for k in PARAMETERS])
            ),
        }
    )


def convert_avro_to_parquet(
    spark: SparkSession, source: str, target: str, profile: str = "flat", where: dict | None = None
) -> None:
    """Avro data set to gzip Parquet under the same partition path, event folder renamed."""
    rows = reconcile(read_customers(spark, source, where), profile)
    gathered = rows.hint("rebalance", *CUSTOMER_PARTITIONS)
    gathered.write.mode("append").partitionBy(*CUSTOMER_PARTITIONS).option("compression", "gzip").parquet(
        f"{target}/{parquet_event()}"
    )


def parquet_event() -> str:
    return f"Parquet_{EVENT}"
