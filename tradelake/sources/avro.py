"""Avro data sets.

Where Spark's Avro module is deployed it does the work. Elsewhere reading goes
through the Hadoop input format that ships with Spark: splittable, any codec,
decoded in the JVM and handed over as JSON. Writing then uses a small Python
data source whose tasks encode their own rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from decimal import Decimal, localcontext
from typing import TYPE_CHECKING, Any
from urllib.parse import quote

from pyarrow import fs as arrow_fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tradelake.functions.text import decimal_from_bytes
from tradelake.session import ship_package
from tradelake.sources.files import list_files

if TYPE_CHECKING:
    import pandas as pd

# Fixed values of the container format.
MAGIC = b"Obj\x01"
SYNC_SIZE = 16
BLOCK_BYTES = 64 * 1024

MOVES_AT_A_TIME = 16

SIMPLE = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def has_avro_module(spark: SparkSession) -> bool:
    """Whether Spark's own Avro source is deployed; any complaint but its absence means yes."""
    try:
        spark.read.format("avro").schema("a int").load([])
    except AnalysisException as error:
        return "Failed to find data source" not in str(error)
    return True


# --- schemas ---------------------------------------------------------------


def avro_schema(
    record: T.StructType, name: str, namespace: str = "", attributes: dict | None = None
) -> dict:
    """The Avro record schema of a Spark struct.

    A string field with ``enum`` in its metadata becomes an enum. ``attributes``
    are further top-level entries, such as a version.
    """
    return {
        **(attributes or {}),
        "namespace": namespace,
        "type": "record",
        "name": name,
        "fields": [_avro_field(f) for f in record.fields],
    }


def _avro_field(f: T.StructField) -> dict:
    if "enum" in f.metadata:
        kind: Any = {"type": "enum", "name": f"{f.name}_enum", "symbols": f.metadata["enum"]}
    else:
        kind = _avro_type(f.dataType, f.name)
    if f.nullable:
        return {"name": f.name, "type": ["null", kind], "default": None}
    return {"name": f.name, "type": kind}


def _avro_type(kind: T.DataType, name: str) -> Any:
    for avro, spark_type in SIMPLE.items():
        if kind == spark_type:
            return avro
    if isinstance(kind, T.BinaryType):
        return "bytes"
    if isinstance(kind, T.DecimalType):
        return {
            "type": "bytes",
            "logicalType": "decimal",
            "precision": kind.precision,
            "scale": kind.scale,
        }
    if isinstance(kind, T.ArrayType):
        item = _avro_type(kind.elementType, f"{name}_item")
        return {"type": "array", "items": ["null", item] if kind.containsNull else item}
    if isinstance(kind, T.MapType):
        value = _avro_type(kind.valueType, f"{name}_value")
        return {"type": "map", "values": ["null", value] if kind.valueContainsNull else value}
    if isinstance(kind, T.StructType):
        return avro_schema(kind, f"{name}_record")
    raise TypeError(f"no Avro type for {kind.simpleString()}")


@dataclass
class Shape:
    """How a schema node looks as JSON, and how to get its Spark value from that."""

    json_type: T.DataType
    convert: Callable[[Column], Column] | None = None

    def value(self, column: Column) -> Column:
        return self.convert(column) if self.convert else column


def _shape(avro: Any) -> Shape:
    if isinstance(avro, list):
        kinds = [kind for kind in avro if kind != "null"]
        if len(kinds) != 1:
            raise TypeError(f"only unions with null are read, not {avro}")
        return _shape(kinds[0])
    kind = avro["type"] if isinstance(avro, dict) else avro
    if isinstance(kind, (dict, list)):
        return _shape(kind)
    if kind in SIMPLE:
        return Shape(SIMPLE[kind])
    if kind == "enum":
        return Shape(T.StringType())
    if kind == "bytes":
        return _bytes_shape(avro if isinstance(avro, dict) else {})
    if kind == "array":
        item = _shape(avro["items"])
        convert = (lambda c: F.transform(c, item.value)) if item.convert else None
        return Shape(T.ArrayType(item.json_type), convert)
    if kind == "map":
        entry = _shape(avro["values"])
        convert = (lambda c: F.transform_values(c, lambda _, v: entry.value(v))) if entry.convert else None
        return Shape(T.MapType(T.StringType(), entry.json_type), convert)
    if kind == "record":
        return _record_shape(avro)
    raise TypeError(f"no Spark type for Avro {kind}")


def _bytes_shape(avro: dict) -> Shape:
    """Bytes come as text with one character per byte."""

    def binary(column: Column) -> Column:
        return F.encode(column, "ISO-8859-1")

    if avro.get("logicalType") != "decimal":
        return Shape(T.StringType(), binary)
    precision, scale = avro["precision"], avro.get("scale", 0)
    return Shape(T.StringType(), lambda c: decimal_from_bytes(binary(c), precision, scale))


def _record_shape(avro: dict) -> Shape:
    shapes = {f["name"]: _shape(f["type"]) for f in avro["fields"]}
    json_type = T.StructType([T.StructField(name, s.json_type) for name, s in shapes.items()])
    if not any(s.convert for s in shapes.values()):
        return Shape(json_type)

    def rebuild(column: Column) -> Column:
        fields = [s.value(column[name]).alias(name) for name, s in shapes.items()]
        return F.when(column.isNotNull(), F.struct(*fields))

    return Shape(json_type, rebuild)


# Fixed value: the folder name that stands for null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# --- reading ---------------------------------------------------------------


def filesystem(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path, as the tasks open it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return arrow_fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    shift = number = 0
    while True:
        byte = data[at]
        at += 1
        number |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return (number >> 1) ^ -(number & 1), at


def parse_header(data: bytes) -> dict[str, bytes]:
    """The metadata map at the start of a container; IndexError if the bytes end before it does."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not an Avro container file")
    found: dict[str, bytes] = {}
    count, at = _varint(data, len(MAGIC))
    while count:
        if count < 0:  # a negative count is followed by the block's size
            _, at = _varint(data, at)
            count = -count
        for _ in range(count):
            pair = []
            for _ in range(2):
                size, at = _varint(data, at)
                if at + size > len(data):
                    raise IndexError("header is longer than the bytes read")
                pair.append(data[at : at + size])
                at += size
            found[pair[0].decode()] = pair[1]
        count, at = _varint(data, at)
    return found


def read_header(path: str) -> dict[str, bytes]:
    """The header of one file; only its first bytes are read."""
    system, inner = filesystem(path)
    size = 16 * 1024
    with system.open_input_file(inner) as source:
        while True:
            source.seek(0)
            data = source.read(size)
            try:
                return parse_header(data)
            except IndexError:
                if len(data) < size:
                    raise ValueError(f"{path} ends inside its header") from None
                size *= 4


METADATA = "path string, name string, namespace string, version string, codec string, schema string"


def _version(schema: dict) -> str | None:
    """The version in the schema's custom metadata entry, whatever its prefix."""
    for key, value in schema.items():
        if key.endswith("meta") and isinstance(value, dict) and "version" in value:
            return value["version"]
    return None


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pandas as pd  # not at the top: tasks that write do without it

    for batch in batches:
        rows = []
        for path in batch["path"]:
            header = read_header(path)
            text = header["avro.schema"].decode("utf-8")
            schema = json.loads(text)
            codec = header.get("avro.codec", b"null").decode()
            rows.append((path, schema["name"], schema.get("namespace"), _version(schema), codec, text))
        yield pd.DataFrame(rows, columns=["path", "name", "namespace", "version", "codec", "schema"])


def avro_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Name, namespace, version and schema from the header of every file below ``path``."""
    ship_package(spark)
    return list_files(spark, path, "*.avro").select("path").mapInPandas(_headers, METADATA)


def _merged_schema(spark: SparkSession, path: str) -> dict:
    """One record schema with the fields of all schemas found; there are as many as versions."""
    rows = avro_metadata(spark, path).groupBy("schema").agg(F.max("path").alias("p")).orderBy("p").collect()
    if not rows:
        raise FileNotFoundError(f"no Avro file below {path}")
    merged: dict = {}
    fields: dict[str, dict] = {}
    for row in rows:
        merged = json.loads(row["schema"])
        for entry in merged["fields"]:
            fields[entry["name"]] = entry
    return {**merged, "fields": list(fields.values())}


def read_avro(
    spark: SparkSession,
    path: str,
    partitions: str | None = None,
    where: dict[str, Any] | None = None,
) -> DataFrame:
    """Decode a data set by the schema in its files.

    ``partitions`` names the path columns in path order, such as
    ``"year int, day int"``; ``where`` picks values of them, and only the
    folders that match are opened.
    """
    parts = T.StructType.fromDDL(partitions) if partitions else T.StructType()
    if has_avro_module(spark):
        data = spark.read.format("avro").load(path)
        for f in parts.fields:
            data = data.withColumn(f.name, F.col(f.name).cast(f.dataType))
        return _picked(data, where)
    picked = _pruned(path, parts, where)
    shape = _record_shape(_merged_schema(spark, picked))
    files = spark.sparkContext.hadoopRDD(
        "org.apache.avro.mapred.AvroAsTextInputFormat",
        "org.apache.hadoop.io.Text",
        "org.apache.hadoop.io.Text",
        conf={
            "mapreduce.input.fileinputformat.inputdir": picked.replace(",", "\\,"),
            "mapreduce.input.fileinputformat.input.dir.recursive": "true",
            "mapreduce.input.fileinputformat.list-status.num-threads": "16",
        },
    )
    texts = spark.createDataFrame(files, "datum string, nothing string", verifySchema=False)
    names = shape.json_type.fieldNames()
    # The file name of a split is known to its task only, so it is taken first.
    rows = texts.select(
        F.from_json("datum", shape.json_type).alias("_r"), F.input_file_name().alias("_file")
    )
    value = shape.value(F.col("_r"))
    data = rows.select(value.alias("_r"), "_file").select(
        *[F.col("_r")[name].alias(name) for name in names],
        *[
            _path_value(F.regexp_extract("_file", rf"/{f.name}=([^/]*)", 1)).cast(f.dataType).alias(f.name)
            for f in parts.fields
        ],
    )
    return _picked(data, where)


def _path_value(text: Column) -> Column:
    """A path column's text: percent-decoded, with ``+`` as it is and the null name as null."""
    plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(plain != NULL_FOLDER, plain)


def _picked(data: DataFrame, where: dict[str, Any] | None) -> DataFrame:
    for name, value in (where or {}).items():
        data = data.filter(F.col(name) == F.lit(value))
    return data


def _pruned(path: str, parts: T.StructType, where: dict[str, Any] | None) -> str:
    if not where:
        return path
    folders = [f"{name}={where.get(name, '*')}" for name in parts.fieldNames()]
    return "/".join([path.rstrip("/"), *folders])


# --- writing ---------------------------------------------------------------


_FLOAT, _DOUBLE = struct.Struct("<f"), struct.Struct("<d")


def _folder_text(value: Any) -> str:
    """A partition value as Hive-style folder names show it."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return quote(str(value), safe=" !$&()+,;@-._~|<>")


def _zigzag(number: int) -> bytes:
    number = (number << 1) ^ (number >> 63)
    out = bytearray()
    while number > 0x7F:
        out.append((number & 0x7F) | 0x80)
        number >>= 7
    out.append(number)
    return bytes(out)


def _sized(data: bytes) -> bytes:
    return _zigzag(len(data)) + data


def _unscaled(value: Decimal, scale: int) -> bytes:
    with localcontext() as context:
        context.prec = 80
        number = int(value.scaleb(scale))
    return number.to_bytes((number + (number < 0)).bit_length() // 8 + 1, "big", signed=True)


def encoder(avro: Any) -> Callable[[Any], bytes]:
    """A function from a Python value to the bytes of this schema node."""
    if isinstance(avro, list):
        null = _zigzag(avro.index("null"))
        place, kind = next((i, k) for i, k in enumerate(avro) if k != "null")
        some, inner = _zigzag(place), encoder(kind)
        return lambda v: null if v is None else some + inner(v)
    kind = avro["type"] if isinstance(avro, dict) else avro
    if kind == "bytes" and isinstance(avro, dict) and avro.get("logicalType") == "decimal":
        return lambda v: _sized(_unscaled(v, avro.get("scale", 0)))
    if kind == "enum":
        codes = {symbol: _zigzag(i) for i, symbol in enumerate(avro["symbols"])}
        return lambda v: codes[v]
    if kind == "array":
        item = encoder(avro["items"])
        return lambda v: b"".join([_zigzag(len(v)), *map(item, v), b"\0"]) if v else b"\0"
    if kind == "map":
        entry = encoder(avro["values"])
        return lambda v: (
            b"".join([_zigzag(len(v)), *[_sized(k.encode()) + entry(x) for k, x in v.items()], b"\0"])
            if v
            else b"\0"
        )
    if kind == "record":
        fields = [(f["name"], encoder(f["type"])) for f in avro["fields"]]
        return lambda v: b"".join([encode(v[name]) for name, encode in fields])
    if isinstance(kind, (dict, list)):
        return encoder(kind)
    return PRIMITIVES[kind]


PRIMITIVES: dict[str, Callable[[Any], bytes]] = {
    "string": lambda v: _sized(v.encode("utf-8")),
    "bytes": lambda v: _sized(bytes(v)),
    "boolean": lambda v: b"\x01" if v else b"\0",
    "int": _zigzag,
    "long": _zigzag,
    "float": lambda v: _FLOAT.pack(v),
    "double": lambda v: _DOUBLE.pack(v),
}


class Container:
    """One open container file of a task."""

    def __init__(self, path: str, schema: dict, codec: str) -> None:
        system, inner = filesystem(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(inner)
        self.sync = uuid.uuid4().bytes
        self.deflate = codec == "deflate"
        self.rows, self.pending = 0, bytearray()
        meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
        entries = b"".join(_sized(k.encode()) + _sized(v) for k, v in meta.items())
        self.out.write(MAGIC + _zigzag(len(meta)) + entries + b"\0" + self.sync)

    def add(self, encoded: bytes) -> None:
        self.pending += encoded
        self.rows += 1
        if len(self.pending) >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            data = bytes(self.pending)
            if self.deflate:
                packer = zlib.compressobj(wbits=-15)
                data = packer.compress(data) + packer.flush()
            self.out.write(_zigzag(self.rows) + _sized(data) + self.sync)
            self.rows, self.pending = 0, bytearray()

    def close(self) -> None:
        self.flush()
        self.out.close()


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: where they are and where they belong."""

    moves: list[tuple[str, str]] = field(default_factory=list)


class AvroWriter(DataSourceWriter):
    """Tasks write below a hidden folder; the commit moves the files of finished tasks."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.schema = json.loads(options["avroschema"])
        self.codec = options.get("codec", "null")
        self.partitions = [name for name in options.get("partitions", "").split(",") if name]
        self.overwrite = overwrite
        self.hidden = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        encode, written = encoder(self.schema), Written()
        current, container = None, None
        for row in iterator:
            key = tuple(row[name] for name in self.partitions)
            if container is None or key != current:
                if container is not None:
                    container.close()
                name = f"part-{uuid.uuid4().hex}.avro"
                folders = [f"{part}={_folder_text(v)}" for part, v in zip(self.partitions, key, strict=True)]
                written.moves.append((f"{self.hidden}/{name}", "/".join([self.path, *folders, name])))
                current, container = key, Container(f"{self.hidden}/{name}", self.schema, self.codec)
            container.add(encode(row))
        if container is not None:
            container.close()
        return written

    def commit(self, messages: list) -> None:
        system, root = filesystem(self.path)
        if self.overwrite:
            hidden = filesystem(self.hidden)[1]
            for old in system.get_file_info(arrow_fs.FileSelector(root, allow_not_found=True)):
                if old.path != hidden:
                    delete = system.delete_dir if old.type == arrow_fs.FileType.Directory else system.delete_file
                    delete(old.path)
        moves = [pair for message in messages if message for pair in message.moves]

        def place(pair: tuple[str, str]) -> None:
            source, target = (filesystem(path)[1] for path in pair)
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            system.move(source, target)

        # On object stores a move is a copy, so several run at a time.
        with ThreadPoolExecutor(MOVES_AT_A_TIME) as pool:
            for _ in pool.map(place, moves):
                pass
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        system, hidden = filesystem(self.hidden)
        if system.get_file_info(hidden).type == arrow_fs.FileType.Directory:
            system.delete_dir(hidden)


class AvroSink(DataSource):
    """Write-only source: options ``path``, ``avroSchema``, ``partitions``, ``codec``."""

    @classmethod
    def name(cls) -> str:
        return "tradelake_avro"

    def writer(self, schema: T.StructType, overwrite: bool) -> AvroWriter:
        return AvroWriter(dict(self.options), overwrite)


def write_avro(
    df: DataFrame,
    path: str,
    schema: dict,
    partitions: list[str] | None = None,
    codec: str = "null",
    mode: str = "append",
) -> None:
    """Write container files, one folder per value of the partition columns.

    The rebalance gathers a folder's rows and splits a folder too large for one task.
    """
    parts = partitions or []
    names = [entry["name"] for entry in schema["fields"]]
    rows = df.select(*names, *parts)
    if parts:
        rows = rows.hint("rebalance", *parts).sortWithinPartitions(*parts)
    if has_avro_module(df.sparkSession):
        writer = rows.write.format("avro").option("avroSchema", json.dumps(schema))
        compression = "uncompressed" if codec == "null" else codec
        writer.option("compression", compression).mode(mode).partitionBy(*parts).save(path)
        return
    ship_package(df.sparkSession)
    df.sparkSession.dataSource.register(AvroSink)
    options = {"avroSchema": json.dumps(schema), "partitions": ",".join(parts), "codec": codec}
    rows.write.format("tradelake_avro").options(**options).mode(mode).save(path)
