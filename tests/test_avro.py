"""Avro data sets: our writer against the Java reader, schemas, conversion."""

from __future__ import annotations

import json
from decimal import Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.operators.nested import avg_by, compare_scan, unnest, with_extras
from tradelake.schemas import CUSTOMER
from tradelake.session import run_dir
from tradelake.sources import customers as store
from tradelake.sources.avro import avro_metadata, avro_schema, parse_header, read_avro, write_avro
from tradelake.sources.files import with_source_path

WIDE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("small", T.IntegerType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("real", T.FloatType()),
        T.StructField("wide", T.DoubleType()),
        T.StructField("word", T.StringType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("money", T.DecimalType(20, 4)),
        T.StructField("kind", T.StringType(), True, {"enum": ["UNKNOWN", "ONE"]}),
        T.StructField("list", T.ArrayType(T.DecimalType(9, 2))),
        T.StructField("dict", T.MapType(T.StringType(), T.BinaryType())),
        T.StructField(
            "deep",
            T.StructType(
                [
                    T.StructField("amount", T.DecimalType(5, 1)),
                    T.StructField("names", T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)


def wide_rows():
    big = Decimal("9999999999999999.9999")
    return [
        (0, None, None, None, None, None, None, None, None, None, None, None),
        (
            2**63 - 1, -(2**31), True, 1.5, -2.5e300, 'q"uo\\te \n ż', bytearray(range(256)), big, "ONE",
            [Decimal("1.25"), None], {"k": bytearray(b'"\x00\xff'), "n": None},
            (Decimal("-0.1"), ["a", None]),
        ),
        (
            -(2**63), 2**31 - 1, False, -0.0, float("inf"), "", bytearray(), -big, "UNKNOWN",
            [], {}, (None, []),
        ),
    ]


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_every_type_survives(spark, folder, codec):
    frame = spark.createDataFrame(wide_rows(), WIDE)
    write_avro(frame, folder, avro_schema(WIDE, "Wide"), codec=codec)
    back = read_avro(spark, folder)
    kinds = {f.name: f.dataType.simpleString() for f in back.schema.fields}
    assert kinds == {f.name: f.dataType.simpleString() for f in WIDE.fields}
    got = sorted(back.collect(), key=lambda r: r.id)
    assert got == sorted(frame.collect(), key=lambda r: r.id)
    assert {r.codec for r in avro_metadata(spark, folder).collect()} == {codec}


def test_many_blocks_and_splits(spark, folder):
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("word"))
    schema = avro_schema(rows.schema, "Rows")
    write_avro(rows.repartition(2), folder, schema)
    back = read_avro(spark, folder)
    assert back.count() == 200_000 and back.exceptAll(rows).isEmpty()


def test_path_columns_and_pruning(spark, folder):
    rows = spark.range(100).selectExpr("id", "concat('p ', id % 3) AS part", "int(id % 2) AS day")
    schema = avro_schema(T.StructType([T.StructField("id", T.LongType())]), "Rows")
    write_avro(rows, folder, schema, ["part", "day"])
    ddl = "part string, day int"
    assert read_avro(spark, folder, ddl).exceptAll(rows).isEmpty()
    picked = read_avro(spark, folder, ddl, {"day": 1})
    assert picked.count() == 50
    assert picked.rdd.getNumPartitions() <= 2 * 3
    paths = with_source_path(picked).select("path", "day").distinct().collect()
    assert len(paths) == 3 and all("/day=1/" in r.path for r in paths)


LINES = st.lists(
    st.tuples(
        st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=20),
        st.one_of(st.none(), st.binary(max_size=12)),
        st.one_of(st.none(), st.integers(-(10**20) + 1, 10**20 - 1)),
        st.floats(allow_nan=False),
    ),
    min_size=1,
    max_size=20,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LINES)
def test_any_value_survives(spark, lines):
    kinds = T.StructType(
        [
            T.StructField("i", T.LongType(), False),
            T.StructField("word", T.StringType(), False),
            T.StructField("data", T.BinaryType()),
            T.StructField("money", T.DecimalType(20, 4)),
            T.StructField("real", T.DoubleType(), False),
        ]
    )
    with localcontext() as context:
        context.prec = 40
        rows = [
            (i, word, data and bytearray(data), None if units is None else Decimal(units).scaleb(-4), real)
            for i, (word, data, units, real) in enumerate(lines)
        ]
    where = run_dir(spark, "any")
    frame = spark.createDataFrame(rows, kinds)
    write_avro(frame, where, avro_schema(kinds, "Any"))
    got = sorted(read_avro(spark, where).collect(), key=lambda r: r.i)
    assert got == sorted(frame.collect(), key=lambda r: r.i)


def test_overwrite_append_and_leftovers(spark, folder):
    schema = avro_schema(T.StructType([T.StructField("id", T.LongType(), False)]), "Rows")
    write_avro(spark.range(5), folder, schema)
    write_avro(spark.range(5, 8), folder, schema)
    assert read_avro(spark, folder).count() == 8
    write_avro(spark.range(3), folder, schema, mode="overwrite")
    assert read_avro(spark, folder).count() == 3
    bad = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        write_avro(bad, folder, schema)
    assert read_avro(spark, folder).count() == 3


def test_unknown_enum_names_are_refused(spark, folder):
    struct = T.StructType([T.StructField("kind", T.StringType(), False, {"enum": ["ONE"]})])
    with pytest.raises(PySparkException):
        write_avro(spark.createDataFrame([("TWO",)], "kind string"), folder, avro_schema(struct, "E"))
    checked = spark.range(1).select(store.checked_enum(F.lit("TWO"), ["ONE"]))
    with pytest.raises(PySparkException, match="not an enum name: TWO"):
        checked.collect()


def test_files_of_two_schema_versions_read_together(spark, folder):
    old = T.StructType([T.StructField("id", T.LongType(), False)])
    new = T.StructType([*old.fields, T.StructField("word", T.StringType())])
    write_avro(spark.range(2), folder, avro_schema(old, "R", "ns", {"our-meta": {"version": "1"}}))
    two = spark.range(2, 4).withColumn("word", F.lit("x"))
    write_avro(two, folder, avro_schema(new, "R", "ns", {"our-meta": {"version": "2"}}))
    assert {(r.id, r.word) for r in read_avro(spark, folder).collect()} == {
        (0, None), (1, None), (2, "x"), (3, "x"),
    }
    found = avro_metadata(spark, folder).select("name", "namespace", "version").distinct().collect()
    assert {tuple(r) for r in found} == {("R", "ns", "1"), ("R", "ns", "2")}


def test_header_parser():
    head = b"Obj\x01\x01\x10\x02a\x02b\x00" + b"s" * 16  # one entry in a block with a size
    assert parse_header(head) == {"a": b"b"}
    with pytest.raises(IndexError):
        parse_header(head[:7])
    with pytest.raises(ValueError):
        parse_header(b"PAR1")


def test_customer_builder(spark):
    made = store.customers(spark, 500, seed=4, days=3)
    assert made.count() == 1500
    one = made.filter("day = 1").drop("day")
    other = made.filter("day = 3").drop("day")
    as_json = F.to_json(F.struct(*one.columns))
    assert one.select(as_json).exceptAll(other.select(as_json)).isEmpty()
    check = made.agg(
        F.min("age"), F.max("age"), F.min(F.size("array_of_strings")), F.max(F.size("array_of_strings")),
        F.countDistinct("customerId"), F.countDistinct("isActive"),
    ).first()
    assert tuple(check) == (20, 70, 1, 5, 500, 2)
    assert made.agg(F.min("accountBalance_logical_dec")).first()[0] < 0
    ours = store.customers(spark, 5, seed=5).select("customerId").first()
    assert ours != made.select("customerId").first()


def test_avro_to_parquet_conversion(spark, folder):
    made = store.customers(spark, 200, days=2)
    store.write_customers(made, folder)
    back = store.read_customers(spark, folder)
    assert [f.dataType.simpleString() for f in back.schema.fields[:8]] == [
        f.dataType.simpleString() for f in CUSTOMER.fields
    ]
    store.convert_avro_to_parquet(spark, folder, folder)
    flat = spark.read.parquet(f"{folder}/{store.parquet_event()}")
    assert flat.schema["parameters"].dataType.simpleString() == "struct<key1:string,key2:string>"
    assert flat.schema["accountBalance_logical_dec"].dataType.simpleString() == "decimal(12,4)"
    assert flat.schema["paymentDetails"].dataType.fieldNames() == [
        "counterPartyName", "groupingId", "message", "otherAccountId", "payeeId", "type",
    ]
    assert flat.count() == 400
    assert any(".gz.parquet" in f for f in flat.inputFiles())
    same = store.reconcile(back, "avro")
    assert same.schema == back.schema
    with pytest.raises(ValueError):
        store.reconcile(back, "other")
    cost = {r.format: r for r in compare_scan(spark, folder, folder, "age", {"day": 1}).collect()}
    assert cost["avro"].avg_age == cost["parquet"].avg_age == avg_by(made, "age", "day = 1").first()[0]
    assert cost["avro"].rows == cost["parquet"].rows == 200
    assert cost["avro"].bytes > cost["parquet"].bytes > 0 and cost["avro"].seconds > 0


def test_unnest_and_extras(spark):
    rows = [("a", ["x", "y"]), ("b", []), ("c", None), ("d", [None])]
    frame = spark.createDataFrame(rows, "k string, v array<string>")
    assert [(r.k, r.n) for r in unnest(frame, "v", "n").collect()] == [("a", "x"), ("a", "y"), ("d", None)]
    assert with_extras(frame, "upper(K) AS big").first().big == "A"
    assert json.loads(json.dumps(store.CUSTOMER_AVRO))["name"] == store.EVENT
