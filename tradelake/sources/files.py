"""Files under a prefix: listing, source path, reset and result export."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import shared_dir


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The path and its file system, as the session's Hadoop settings resolve them."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(context._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path, size and time of every file below ``path``; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, without hidden ones."""
    where, fs = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def with_source_path(df: DataFrame, name: str = "path") -> DataFrame:
    """Add the file each row came from."""
    try:
        return df.withColumn(name, F.col("_metadata.file_path"))
    except AnalysisException:  # sources without a metadata column, such as RDD-backed scans
        return df.withColumn(name, F.input_file_name())


def delete_prefix(spark: SparkSession, path: str, root: str | None = None) -> bool:
    """Delete everything below ``path``, which has to lie inside ``root``.

    ``root`` is the shared folder unless the caller names its own output root.
    """
    where, fs = hadoop_path(spark, path)
    base, _ = hadoop_path(spark, root or shared_dir(spark))
    inner, outer = fs.makeQualified(where).toUri().normalize(), fs.makeQualified(base).toUri().normalize()
    relative = outer.relativize(inner)
    if relative.isAbsolute() or not relative.getPath() or relative.getPath().startswith(".."):
        raise ValueError(f"{path} is not inside {outer}")
    return fs.exists(where) and fs.delete(where, True)


def reset_table(spark: SparkSession, name: str, path: str, root: str | None = None) -> None:
    """Drop a table and the data under its prefix."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    delete_prefix(spark, path, root)


def export_result(df: DataFrame, path: str) -> None:
    """Write a query result as CSV with a header; null and empty text stay apart."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
