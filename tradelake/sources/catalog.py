"""Databases, external tables and their partitions."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradelake.sources.avro import has_avro_module, read_avro
from tradelake.sources.files import child_folders, hadoop_path


def recreate_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    spark.sql(f"CREATE DATABASE `{name}`")


def create_zones(spark: SparkSession, zones: dict[str, str]) -> None:
    """One database per zone, kept if it is there; ``zones`` maps zone to database name."""
    for database in zones.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def create_table(
    spark: SparkSession,
    name: str,
    columns: T.StructType | str,
    partitions: T.StructType | str,
    path: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Create or replace an external table with explicit columns and path columns.

    A partitioned table shows rows once its partitions are added or repaired.
    Avro without Spark's module becomes a temporary view of that name.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    data, parts = _ddl(columns), _ddl(partitions)
    if fmt == "avro" and not has_avro_module(spark):
        read_avro(spark, path, parts or None).createOrReplaceTempView(name.split(".")[-1])
        return
    listed = f"{data}, {parts}" if parts else data
    by = ", ".join(f"`{f.name}`" for f in T.StructType.fromDDL(parts).fields) if parts else ""
    given = ", ".join(f"{_literal(key)} {_literal(value)}" for key, value in (options or {}).items())
    spark.sql(
        f"CREATE TABLE {name} ({listed}) USING {fmt}"
        + (f" OPTIONS ({given})" if given else "")
        + (f" PARTITIONED BY ({by})" if by else "")
        + f" LOCATION {_literal(path)}"
    )


def _literal(value: str | int) -> str:
    """A SQL text literal."""
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _ddl(schema: T.StructType | str) -> str:
    if isinstance(schema, str):
        return schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def add_partition(spark: SparkSession, table: str, values: dict[str, str | int], path: str) -> None:
    """Register one partition at its own location."""
    spec = ", ".join(f"`{name}`={_literal(value)}" for name, value in values.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {_literal(path)}")


# Fixed value: the folder name of rows whose path column is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# Partitions that one statement registers.
PARTITIONS = 500


def add_partitions(spark: SparkSession, table: str, specs: list[dict[str, str]], root: str) -> None:
    """Register partitions below ``root`` by the values in their folders' names, many in a statement."""
    for at in range(0, len(specs), PARTITIONS):
        listed = []
        for spec in specs[at : at + PARTITIONS]:
            where = "/".join(f"{name}={value}" for name, value in spec.items())
            values = ", ".join(f"`{name}`={_value(value)}" for name, value in spec.items())
            listed.append(f"PARTITION ({values}) LOCATION {_literal(f'{root.rstrip('/')}/{where}')}")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(listed)}")


def _value(folder: str) -> str:
    """The value that a folder's name stands for, as SQL."""
    return "NULL" if folder == NULL_FOLDER else _literal(unquote(folder))


def repair(spark: SparkSession, table: str) -> None:
    """Register every partition folder below the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


# First bytes that tell a file's format.
MARKS = {b"PAR1": "parquet", b"Obj\x01": "avro", b"{": "json", b"[": "json"}


def _first_file(spark: SparkSession, path: str) -> str | None:
    """A data file below ``path``; the listing stops at the first one."""
    where, fs = hadoop_path(spark, path)
    base = fs.makeQualified(where).toString()
    files = fs.listFiles(where, True)
    while files.hasNext():
        status = files.next()
        found = status.getPath().toString()
        hidden = any(part.startswith(("_", ".")) for part in found[len(base) :].split("/"))
        if not hidden and status.getLen() > 0:
            return found
    return None


def classify(spark: SparkSession, file: str) -> str:
    """Format of a file by its first bytes; anything unknown is CSV."""
    where, fs = hadoop_path(spark, file)
    stream = fs.open(where)
    try:
        start = bytes(b for b in (stream.read() for _ in range(4)) if b >= 0)
    finally:
        stream.close()
    return next((fmt for mark, fmt in MARKS.items() if start.startswith(mark)), "csv")


def crawl(
    spark: SparkSession,
    root: str,
    database: str,
    prefix: str = "",
    table: str | None = None,
    sampling: float = 1.0,
    refresh: bool = False,
) -> list[str]:
    """Register what lies below ``root`` and return the table names.

    Each folder directly below becomes a table named prefix plus folder, so a
    first-level ``year=2024`` goes into the name and not into the columns. With
    ``table``, or without any folder, the whole root becomes one table. Path columns are texts,
    which keeps leading zeros. A known table only gets its new partitions, so
    the job can be repeated often; ``sampling`` is the share of text rows that
    schema inference reads on the first run. ``refresh`` infers the columns anew.
    """
    base = root.rstrip("/")
    if table:
        roots = {table: base}
    else:
        roots = {name: f"{base}/{name}" for name in child_folders(spark, root)} or {base.rsplit("/", 1)[-1]: base}
    found: list[str] = []
    for folder, path in roots.items():
        file = _first_file(spark, path)
        if file is None:
            continue
        name = f"`{database}`.`{prefix}{re.sub('[^a-z0-9_]', '_', folder.lower())}`"
        if name in found:
            raise ValueError(f"two folders below {root} would both become {name}")
        parts = _path_columns(spark, path, file)
        if refresh or not spark.catalog.tableExists(name):
            _register(spark, name, path, classify(spark, file), parts, sampling)
        if parts:
            repair(spark, name)
        found.append(name)
    return found


def _path_columns(spark: SparkSession, path: str, file: str) -> list[str]:
    where, fs = hadoop_path(spark, path)
    inner = file[len(fs.makeQualified(where).toString()) :]
    return [part.split("=", 1)[0] for part in inner.split("/")[:-1] if "=" in part]


def _register(
    spark: SparkSession, name: str, path: str, fmt: str, parts: list[str], sampling: float
) -> None:
    if fmt == "avro":
        ddl = ", ".join(f"`{part}` string" for part in parts)
        columns = read_avro(spark, path, ddl).schema
        options = {}
    else:
        options = {"header": "true"} if fmt == "csv" else {}
        reader = spark.read.options(**options)
        if fmt == "json":
            reader = reader.option("samplingRatio", sampling)
        columns = reader.format(fmt).load(path).schema
    kept = T.StructType([f for f in columns.fields if f.name not in parts])
    by = T.StructType([T.StructField(part, T.StringType()) for part in parts])
    create_table(spark, name, kept, by, path, fmt, options)
