"""Text files of a few lines each, written and read by tasks.

Hadoop's local file system starts processes for each new file, and Spark's file sink gathers
every file's name in the driver. An archive of ten records per file pays both for each ten
records. Here tasks open the files themselves, and their names go to a Parquet list for each
batch under ``_files``, from which tasks read them again. The folders are those of the file
sink, so that other readers find the files by their paths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tradelake.session import ship_package
from tradelake.sources.files import hadoop_path

#: What a null or empty value is called in a path, and the characters that a path may not hold.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
UNSAFE = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

#: Lines held before they go to their file, if no number of records bounds it, and rows of a batch that is read.
LINES = 10_000


def folder_of(names: list[str], values: tuple) -> str:
    """``name=value`` for each value, as Spark writes them."""
    return "/".join(f"{n}={UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', v) if v else NO_VALUE}" for n, v in zip(names, values))


def values_of(file: str) -> list[str | None]:
    """The values in a file's path, as text."""
    values = [unquote(part.split("=", 1)[1]) for part in file.split("/")[:-1]]
    return [None if v == NO_VALUE else v for v in values]


def opened(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a qualified folder and the folder's path in it."""
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return arrow_fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe="/:%"))


def qualified(spark: SparkSession, path: str) -> str:
    where, fs = hadoop_path(spark, path)
    return fs.makeQualified(where).toString()


def write_batch(rows: DataFrame, batch: int, path: str, names: list[str], most: int | None) -> None:
    """Write ``value`` lines of the rows below the folders of ``names``, at most ``most`` in a file.

    The rows are sorted in their partitions and files named by task, batch and number, so
    that a repeated task writes the same files again. A batch that is run again, as after a
    restart, first removes what it had written.
    """
    spark = rows.sparkSession
    ship_package(spark)
    listed, fs = hadoop_path(spark, f"{path}/_files/batch={batch}")
    if fs.exists(listed):
        stale = hadoop_path(spark, f"{path}/{'*/' * len(names)}part-*-{batch:06d}-*.txt")[0]
        for status in fs.globStatus(stale) or []:
            fs.delete(status.getPath(), False)
    root = qualified(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = opened(root)
        task = TaskContext.get().partitionId()
        now, folder, out, held, count, number = None, "", None, [], 0, 0
        files: list[str] = []

        def put(end: bool) -> None:
            nonlocal out, held, count, number
            if held:
                if out is None:
                    files.append(f"{folder}/part-{task:05d}-{batch:06d}-{number:08d}.txt")
                    out = where.open_output_stream(f"{base}/{files[-1]}")
                    number += 1
                out.write("".join(f"{line}\n" for line in held).encode("utf-8", "surrogatepass"))
                held = []
            if end and out is not None:
                out.close()
                out, count = None, 0

        for part in batches:
            keys = zip(*(part.column(name).to_pylist() for name in names))
            for key, line in zip(keys, part.column("value").to_pylist()):
                if key != now or (most and count >= most):
                    put(True)
                    count = 0
                    if key != now:
                        now, folder = key, folder_of(names, key)
                        where.create_dir(f"{base}/{folder}", recursive=True)
                held.append(line)
                count += 1
                if len(held) >= LINES:
                    put(False)
            if files:
                yield pa.RecordBatch.from_pydict({"file": files})
                files = []
        put(True)
        if files:
            yield pa.RecordBatch.from_pydict({"file": files})

    rest = [c for c in rows.columns if c not in names]
    done = rows.sortWithinPartitions(*names, *rest).select(*names, "value").mapInArrow(run, "file string")
    done.write.mode("overwrite").parquet(f"{path}/_files/batch={batch}")


def small_files(path: str, names: list[str], most: int | None, gather: list | None = None) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that writes each batch, gathered as a rebalance hint says."""

    def write(rows: DataFrame, batch: int) -> None:
        write_batch(rows.hint("rebalance", *gather) if gather else rows, batch, path, names, most)

    return write


def read_small_files(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The lines of all listed files, the values in their paths as text, and the files."""
    ship_package(spark)
    root = qualified(spark, path)
    where, fs = hadoop_path(spark, f"{path}/_files")
    listed = spark.read.schema("file string").parquet(f"{path}/_files") if fs.exists(where) else spark.createDataFrame([], "file string")
    schema = ", ".join(["value string", *(f"{name} string" for name in names), "file string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        kinds = pa.schema([(name, pa.string()) for name in ("value", *names, "file")])
        rows: list[tuple] = []

        def frame() -> pa.RecordBatch:
            columns = [pa.array(column, pa.string()) for column in zip(*rows)]
            return pa.RecordBatch.from_arrays(columns, schema=kinds)

        for part in batches:
            for file in part.column("file").to_pylist():
                more = (*values_of(file), file)
                with system.open_input_stream(f"{base}/{file}") as stream:
                    ends = b""
                    while data := stream.read(1 << 20):
                        *lines, ends = (ends + data).split(b"\n")
                        rows += [(line.decode("utf-8", "replace"), *more) for line in lines]
                        if len(rows) >= LINES:
                            yield frame()
                            rows = []
                if ends:
                    rows.append((ends.decode("utf-8", "replace"), *more))
        if rows:
            yield frame()

    # A name stands for a file to open: their number decides on tasks, not their bytes.
    tasks = 4 * spark.sparkContext.defaultParallelism
    return listed.select("file").repartition(tasks).mapInArrow(run, schema)
