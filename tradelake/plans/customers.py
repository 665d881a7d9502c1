"""Queries over nested customer records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.text import decimal_from_bytes
from tradelake.operators import nested
from tradelake.plans.inputs import table
from tradelake.plans.registry import query
from tradelake.schemas import CUSTOMER_PARTITIONS, PAYMENT_TYPES
from tradelake.session import run_dir
from tradelake.sources import customers as store
from tradelake.sources.avro import avro_metadata
from tradelake.sources.files import list_files, with_source_path
from tradelake.sources.footers import column_bytes, count_from_footers, write_for_lookup


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table as nested records, spread over ten days."""
    key = F.col("c_custkey")
    names = F.transform(
        F.sequence(F.lit(1), (key % 5 + 1).cast("int")), lambda i: F.concat(F.lit("n"), i.cast("string"))
    )
    ident = F.concat(F.lit("C"), key.cast("string"))
    kind = F.element_at(F.array(*[F.lit(name) for name in PAYMENT_TYPES]), (key % 3 + 1).cast("int"))
    group = F.concat(F.lit("G"), (key % 7).cast("string"))
    rows = table(spark, sf_dir, "customer").select(
        ident.alias("customerId"),
        (key % 2 == 0).alias("isActive"),
        (key % 51 + 20).cast("int").alias("age"),
        (key % 1000 / 8).cast("float").alias("balance"),
        F.col("c_acctbal").cast("decimal(20,4)").alias("accountBalance_logical_dec"),
        F.when(key % 10 != 9, names).alias("array_of_strings"),
        store.payment(F.col("c_name"), group, kind, ident).alias("paymentDetails"),
        store.parameters().alias("parameters"),
        key,
    )
    return store.dated(rows, 2020, 2, key % 10 + 1).drop("c_custkey")


CUSTOMERS_SQL = """
customers AS (
  SELECT 'C' || c_custkey AS customerId, c_custkey % 2 = 0 AS isActive,
         CAST(c_custkey % 51 + 20 AS INTEGER) AS age, CAST(c_custkey % 1000 / 8.0 AS FLOAT) AS balance,
         CAST(c_acctbal AS DECIMAL(20, 4)) AS account,
         CASE WHEN c_custkey % 10 <> 9
              THEN list_transform(range(1, c_custkey % 5 + 2), lambda i: 'n' || i) END AS names,
         c_name AS counterparty, 'G' || (c_custkey % 7) AS grouping_id,
         ['UNKNOWN', 'ONE', 'TWO'][c_custkey % 3 + 1] AS kind, 'C' || c_custkey AS other,
         'value1' AS key1, 'value2' AS key2, CAST(c_custkey % 10 + 1 AS INTEGER) AS day
  FROM customer)
"""


def _flat(df: DataFrame) -> DataFrame:
    """Nested customer columns side by side; works for both type profiles."""
    paid = "paymentDetails"
    return df.select(
        "customerId",
        "isActive",
        "age",
        "balance",
        F.col("accountBalance_logical_dec").cast("string").alias("account"),
        F.array_join("array_of_strings", ",").alias("names"),
        F.col(f"{paid}.counterPartyName").alias("counterparty"),
        F.col(f"{paid}.groupingId").alias("grouping_id"),
        F.col(f"{paid}.type").alias("kind"),
        F.col(f"{paid}.message").alias("message"),
        F.col("parameters.key1").alias("key1"),
        F.col("parameters.key2").alias("key2"),
        "day",
    )


def _avro(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = run_dir(spark, label)
    store.write_customers(customers(spark, sf_dir), path)
    return path


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT customerId, isActive, age, balance, CAST(account AS VARCHAR) AS account, array_to_string(names, ',') AS names,
       counterparty, grouping_id, kind, CAST(NULL AS VARCHAR) AS message, key1, key2, day
FROM customers
""")
def avro_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(store.read_customers(spark, _avro(spark, sf_dir, "avro")))


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT DISTINCT '{store.EVENT}' AS name, '{store.NAMESPACE}' AS namespace, '{store.VERSION}' AS version,
       'null' AS codec, day
FROM customers
""")
def avro_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the headers of each day's files say."""
    found = avro_metadata(spark, _avro(spark, sf_dir, "headers"))
    day = F.regexp_extract("path", "/day=([0-9]+)/", 1).cast("int").alias("day")
    return found.select("name", "namespace", "version", "codec", day).distinct()


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT customerId, isActive, CAST(age AS BIGINT) AS age, CAST(balance AS DOUBLE) AS balance,
       CAST(CAST(account AS DECIMAL(12, 4)) AS VARCHAR) AS account, array_to_string(names, ',') AS names,
       counterparty, grouping_id, kind, CAST(NULL AS INTEGER) AS message, key1, key2, day
FROM customers
""")
def avro_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _avro(spark, sf_dir, "convert")
    store.convert_avro_to_parquet(spark, path, path)
    return _flat(spark.read.parquet(f"{path}/{store.parquet_event()}"))


@query(f"""
WITH {CUSTOMERS_SQL}, picked AS (SELECT avg(age) AS avg_age, count(*) AS rows FROM customers WHERE day = 1)
SELECT unnest(['avro', 'parquet']) AS format, avg_age, rows, true AS fewer_bytes, true AS bytes_of_footers FROM picked
""")
def scan_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same average on both formats, and whether bytes read compare as they should.

    Seconds and sizes differ by machine and writer: Parquet has to read fewer bytes than
    Avro, and as many as Spark's own scan of the column's chunks names in the footers.
    """
    path = _avro(spark, sf_dir, "scan")
    store.convert_avro_to_parquet(spark, path, path)
    found = nested.compare_scan(spark, path, path, "age", {"day": 1})
    size = {row.format: row.bytes for row in found.collect()}
    day = f"{path}/{store.parquet_event()}/*/*/*/day=1/*"
    whole = column_bytes(spark, day, ["age"]).agg(F.sum("bytes"), F.sum("length")).first()
    return found.select(
        "format", "avg_age", "rows", F.lit(size["parquet"] < size["avro"]).alias("fewer_bytes"),
        F.lit(0 < size["parquet"] == whole[0] < whole[1]).alias("bytes_of_footers"),
    )


@query("""
WITH named AS (SELECT c_custkey, md5('7:customer:' || c_custkey) AS h FROM customer)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS customerId,
       CAST(day AS INTEGER) AS day, 'ONE' AS kind, true AS within
FROM named, range(1, 11) t(day)
""")
def customer_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A made-up customer for each key of the customer table, on ten days; ``within`` if its values are in their ranges."""
    made = store.customers_of(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), seed=7)
    account = F.abs("accountBalance_logical_dec") <= 100_000_000
    within = F.col("age").between(20, 70) & F.size("array_of_strings").between(1, 5) & F.col("balance").between(0, 123) & account
    return made.select("customerId", "day", F.col("paymentDetails.type").alias("kind"), within.alias("within"))


def _parquet(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Customers as Parquet in the nested partition layout."""
    path = run_dir(spark, label)
    rows = customers(spark, sf_dir).hint("rebalance", *CUSTOMER_PARTITIONS)
    rows.write.partitionBy(*CUSTOMER_PARTITIONS).parquet(path)
    return path


@query(f"WITH {CUSTOMERS_SQL} SELECT avg(age) AS avg_age FROM customers WHERE day = 1")
def partition_pruned_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.avg_by(spark.read.parquet(_parquet(spark, sf_dir, "pruned")), "age", "day = '1'")


@query("SELECT count(*) AS rows FROM customer")
def count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.count_rows(spark.read.parquet(_parquet(spark, sf_dir, "count")))


@query("SELECT count(*) AS rows FROM customer")
def count_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count out of the footers, without reading a column."""
    return count_from_footers(spark, _parquet(spark, sf_dir, "footers"))


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT customerId, 'namespace={store.NAMESPACE}/year=2020/month=2/day=3/version={store.VERSION}' AS folder
FROM customers WHERE customerId = 'C72' AND day = 3
""")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer of one day and the folder its file lies in."""
    rows = with_source_path(spark.read.parquet(_parquet(spark, sf_dir, "lookup")))
    found = rows.filter((F.col("customerid") == "C72") & (F.col("day") == 3))
    folder = F.regexp_extract("path", "(namespace=.*)/[^/]*$", 1).alias("folder")
    return found.select("customerId", folder)


@query(f"""
WITH {CUSTOMERS_SQL}, asked AS (SELECT 'C' || (1 + 97 * range) AS id FROM range(10))
SELECT customerId, age, day, true AS skipped FROM customers WHERE customerId IN (SELECT id FROM asked)
""")
def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten customers out of files clustered by their ids; ``skipped`` if row groups were passed over."""
    path = run_dir(spark, "clustered")
    spread = customers(spark, sf_dir).drop("namespace", "year", "month", "version")
    write_for_lookup(spread.repartition(8), path, "customerId", ["day"])
    ids = [f"C{1 + 97 * k}" for k in range(10)]
    about = column_bytes(spark, path, ["age"], "customerId", ids[0], ids[0]).agg(F.sum("row_groups"), F.sum("read_groups")).first()
    found = spark.read.parquet(path).filter(F.col("customerId").isin(ids))
    return found.select("customerId", "age", "day", F.lit(about[1] < about[0]).alias("skipped"))


@query(f"WITH {CUSTOMERS_SQL} SELECT customerId, age, day, grouping_id AS groupingid FROM customers")
def nested_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = nested.with_extras(customers(spark, sf_dir), "paymentdetails.groupingid AS groupingid")
    return extra.select("customerId", "age", "day", "groupingid")


@query(f"WITH {CUSTOMERS_SQL} SELECT customerId, day, unnest(names) AS name FROM customers")
def unnest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.unnest(customers(spark, sf_dir), "array_of_strings", "name").select(
        "customerId", "day", "name"
    )


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT customerId, grouping_id AS groupingid, unnest(names) AS name,
       'namespace={store.NAMESPACE}/year=2020/month=2/day=4/version={store.VERSION}' AS folder
FROM customers WHERE customerId = 'C73' AND day = 4
""")
def unnest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer of one day of the Avro set: nested field, file and one row per array element."""
    rows = store.read_customers(spark, _avro(spark, sf_dir, "find"), {"day": 4})
    found = with_source_path(rows).filter("customerid = 'C73'")
    wide = nested.unnest(
        nested.with_extras(found, "paymentdetails.groupingid AS groupingid"), "array_of_strings", "name"
    )
    folder = F.regexp_extract("path", "(namespace=.*)/[^/]*$", 1).alias("folder")
    return wide.select("customerId", "groupingid", "name", folder)


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT DISTINCT 'namespace={store.NAMESPACE}/year=2020/month=2/day=' || day || '/version={store.VERSION}'
       AS folder
FROM customers
""")
def list_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, _parquet(spark, sf_dir, "listing"), "*.parquet")
    folder = F.regexp_extract("path", "(namespace=.*)/[^/]*$", 1)
    return files.select(folder.alias("folder")).distinct()


@query("""
SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(20, 4)) - 5000 AS VARCHAR) AS balance FROM customer
""")
def decimal_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances, moved to both signs, out of their eight-byte unscaled form."""
    money = F.col("c_acctbal").cast("decimal(20,4)") - F.lit(5000)
    unscaled = (money * 10000).cast("bigint")
    data = F.unhex(F.lpad(F.hex(unscaled), 16, "0"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", decimal_from_bytes(data, 20, 4).cast("string").alias("balance")
    )
