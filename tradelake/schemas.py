"""Schemas of the records the lake holds."""

from __future__ import annotations

from pyspark.sql import types as T

# The trade fields, in the order in which their presence is checked.
TRADE = T.StructType(
    [
        T.StructField("transaction_ts", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("dollar_amount", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("trans_id", T.LongType()),
    ]
)

TRADE_TEXT = T.StructType([T.StructField(name, T.StringType()) for name in TRADE.names])

# The columns kept inside processed files and the columns kept in their path.
PROCESSED_COLUMNS = ["transaction_date", "price", "amount", "dollar_amount", "type", "trans_id"]
PROCESSED_PARTITIONS = ["symbol", "year", "month", "day", "hour"]

PROCESSED = T.StructType(
    [
        T.StructField("transaction_date", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("dollar_amount", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("trans_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
    ]
)

# One record of the keyed stream. The payload is base64 of a UTF-8 JSON line.
LOG = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("arrival_ts", T.TimestampType()),
        T.StructField("data", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("shard", T.IntegerType()),
    ]
)

TOPIC_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# The names an enum column may hold.
PAYMENT_TYPES = ["UNKNOWN", "ONE", "TWO"]

PAYMENT = T.StructType(
    [
        T.StructField("counterPartyName", T.StringType()),
        T.StructField("groupingId", T.StringType()),
        T.StructField("payeeId", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("type", T.StringType(), False, {"enum": PAYMENT_TYPES}),
        T.StructField("otherAccountId", T.StringType()),
    ]
)

CUSTOMER = T.StructType(
    [
        T.StructField("customerId", T.StringType(), False),
        T.StructField("isActive", T.BooleanType(), False),
        T.StructField("age", T.IntegerType(), False),
        T.StructField("balance", T.FloatType(), False),
        T.StructField("accountBalance_logical_dec", T.DecimalType(20, 4), False),
        T.StructField("array_of_strings", T.ArrayType(T.StringType(), False)),
        T.StructField("paymentDetails", PAYMENT),
        T.StructField("parameters", T.MapType(T.StringType(), T.StringType(), False)),
    ]
)

CUSTOMER_PARTITIONS = ["namespace", "year", "month", "day", "version"]
