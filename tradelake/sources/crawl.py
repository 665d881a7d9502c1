"""Repeated crawl of a zone: opens the files that are new, widens the table's columns, adds partitions.

What was seen is kept as rows of path, size, time and schema in a folder of the caller. A
crawl lists the zone, leaves out what it has seen in that form, and infers the schema of
the new files in Spark jobs, which merge the types of lines and files in their tasks. The
result is merged with the table's columns by the widening rules below. Types only ever
widen, so files that were read before stay readable.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.text import decode_key
from tradelake.sources.catalog import add_partitions, create_table, repair
from tradelake.sources.files import hadoop_path, list_files

SEEN = "path string, length bigint, modificationTime timestamp, schema string"
# Files whose names one scan is given at a time.
FILES = 10_000

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_REAL = [T.FloatType(), T.DoubleType()]


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that reads values of both; text where there is none but that."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widened(a.keyType, b.keyType), widened(a.valueType, b.valueType))
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if a in _REAL + _WHOLE and b in _REAL + _WHOLE:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if {type(a), type(b)} <= {T.DecimalType, *map(type, _WHOLE + _REAL)}:
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, those of ``a`` first; names match in any case, every field may be null."""
    later = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        other = later.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, widened(f.dataType, other.dataType) if other else f.dataType))
    fields += [T.StructField(f.name, f.dataType) for f in b.fields if f.name.lower() in later]
    return T.StructType(fields)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _from_variant(text: str | None) -> str:
    """The schema of an aggregated variant as column types: exact fractions become doubles."""
    if text is None or not text.startswith("OBJECT<"):
        return ""
    text = text.replace("OBJECT<", "STRUCT<").replace("VARIANT", "STRING")
    text = re.sub(r"DECIMAL\(\d+,\s*0\)", "BIGINT", text)
    return re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", text)[len("STRUCT<") : -1]


def json_schemas(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, schema`` of JSON-lines files, and without a path that of all together.

    Every line counts; lines that are no JSON object add nothing. One aggregation merges
    the types of a file's lines and those of all files, in the tasks first.
    """
    lines = spark.read.schema("value string").text(paths).select("value", decode_key(F.col("_metadata.file_path")).alias("path"))
    found = lines.rollup("path").agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("schema"))
    return found.select("path", "schema")


def parquet_schemas(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Files with the schema Spark's own merge of their footers gives.

    Files whose types differ cannot be merged there; they are halved until each part can.
    """
    try:
        return [(paths, spark.read.option("mergeSchema", True).parquet(*paths).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        half = len(paths) // 2
        return parquet_schemas(spark, paths[:half]) + parquet_schemas(spark, paths[half:])


@dataclass
class Crawl:
    """What a crawl did: how many files it opened, whether the columns changed, the partitions it saw."""

    opened: int
    changed: bool
    partitions: int


def crawl_changes(
    spark: SparkSession, root: str, table: str, state: str, fmt: str = "json", glob: str | None = None
) -> Crawl:
    """Bring ``table`` up to date with the files below ``root``.

    The first crawl registers the table. Path columns are texts. A file that was replaced
    is opened again. The state is written last: a crawl that fails repeats its work.
    """
    where, fs = hadoop_path(spark, root)
    base = fs.makeQualified(where).toString().rstrip("/")
    kept, _ = hadoop_path(spark, state)
    known = spark.read.schema(SEEN).parquet(state) if fs.exists(kept) else spark.createDataFrame([], SEEN)
    listed = list_files(spark, root, glob).filter("length > 0")
    fresh = listed.join(known, ["path", "length", "modificationTime"], "left_anti").persist()
    opened, folders, new, found = 0, set(), T.StructType([]), spark.createDataFrame([], "path string, schema string")
    for batch in _batches(row.path for row in fresh.select("path").orderBy("path").toLocalIterator()):
        schemas, whole = _schemas(spark, batch, fmt)
        new, found = merged(new, whole), found.unionByName(schemas)
        folders |= {_folder(base, path) for path in batch}
        opened += len(batch)
    if not opened:
        fresh.unpersist()
        return Crawl(0, False, 0)
    parts = sorted({tuple(p.split("=", 1)[0] for p in folder) for folder in folders})
    if len(parts) > 1:
        raise ValueError(f"files below {root} have different path columns: {parts}")
    columns = list(parts[0])
    old = _columns(spark, table, columns)
    whole = _settled(merged(old, new) if old is not None else new, columns)
    changed = whole != old
    if changed:
        create_table(spark, table, whole, T.StructType([T.StructField(name, T.StringType()) for name in columns]), base, fmt)
        if columns:
            repair(spark, table)
    elif columns:
        add_partitions(spark, table, [dict(p.split("=", 1) for p in folder) for folder in sorted(folders)], base)
    seen = fresh.join(found, "path", "left").select("path", "length", "modificationTime", "schema")
    seen.write.mode("append").parquet(state)
    fresh.unpersist()
    return Crawl(opened, changed, len(folders))


def _batches(paths: Iterator[str]) -> Iterator[list[str]]:
    paths = iter(paths)
    while batch := list(islice(paths, FILES)):
        yield batch


def _schemas(spark: SparkSession, paths: list[str], fmt: str) -> tuple[DataFrame, T.StructType]:
    """``path, schema`` of the files and the schema of all together."""
    if fmt == "json":
        rows = json_schemas(spark, paths).persist()
        total = rows.filter("path IS NULL").first()
        return rows.filter("path IS NOT NULL"), T.StructType.fromDDL(_from_variant(total.schema if total else None) or "")
    if fmt == "parquet":
        parts = parquet_schemas(spark, paths)
        whole = T.StructType([])
        for _, schema in parts:
            whole = merged(whole, schema)
        rows = [(path, _ddl(schema)) for part, schema in parts for path in part]
        return spark.createDataFrame(rows, "path string, schema string"), whole
    raise ValueError(f"no repeated crawl of {fmt} files")


def _folder(base: str, path: str) -> tuple[str, ...]:
    """The path parts ``name=value`` of a file."""
    return tuple(part for part in path[len(base) :].split("/")[:-1] if "=" in part)


def _columns(spark: SparkSession, table: str, parts: list[str]) -> T.StructType | None:
    if not spark.catalog.tableExists(table):
        return None
    fields = [f for f in spark.table(table).schema.fields if f.name not in parts]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _settled(schema: T.StructType, parts: list[str]) -> T.StructType:
    """Columns as a table can have them: path columns apart, values only ever null as text."""

    def plain(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.NullType):
            return T.StringType()
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind.fields])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(plain(kind.elementType))
        if isinstance(kind, T.MapType):
            return T.MapType(plain(kind.keyType), plain(kind.valueType))
        return kind

    return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in schema.fields if f.name not in parts])
