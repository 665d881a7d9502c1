"""What a query reads of Parquet files, by their footers, and what of them it can pass over."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.sources.avro import filesystem
from tradelake.sources.files import list_files

#: Files whose footers one task reads at a time.
BATCH = 64


def _meets(group, places: dict[str, int], column: str | None, low: object, high: object) -> bool:
    """Whether a row group may hold a value of the range, by its least and largest value."""
    if column is None or column not in places:
        return True
    found = group.column(places[column]).statistics
    if found is None or not found.has_min_max:
        return True
    return not ((high is not None and found.min > high) or (low is not None and found.max < low))


def column_bytes(
    spark: SparkSession, path: str, columns: list[str], where: str | None = None, low: object = None, high: object = None
) -> DataFrame:
    """Per file below ``path``: ``path, length, row_groups, read_groups, rows, bytes``.

    ``bytes`` are those of the chunks of ``columns`` and of ``where`` in the row groups
    that may hold a value of ``where`` from ``low`` to ``high``, as a reader with pushed-down
    filters takes them. A nested column counts with all its leaves; path columns cost
    nothing. Tasks read footers alone, and their number is that of the files.
    """
    wanted = {*columns, *([where] if where else [])}

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, length in zip(frame["path"], frame["length"]):
                system, inner = filesystem(name)
                with system.open_input_file(inner) as file:
                    about = pq.ParquetFile(file).metadata
                leaves = [about.schema.column(i).path for i in range(about.num_columns)]
                places = {leaf: i for i, leaf in enumerate(leaves)}
                chosen = [i for i, leaf in enumerate(leaves) if leaf.split(".", 1)[0] in wanted]
                kept = [g for k in range(about.num_row_groups) if _meets(g := about.row_group(k), places, where, low, high)]
                size = sum(g.column(i).total_compressed_size for g in kept for i in chosen)
                out.append((name, length, about.num_row_groups, len(kept), sum(g.num_rows for g in kept), size))
            yield pd.DataFrame(out, columns=["path", "length", "row_groups", "read_groups", "rows", "bytes"])

    files = list_files(spark, path, "*.parquet").select("path", "length")
    tasks = max(1, min(files.count() // BATCH, spark.sparkContext.defaultParallelism * 16))
    return files.repartition(tasks).mapInPandas(
        read, "path string, length bigint, row_groups bigint, read_groups bigint, rows bigint, bytes bigint"
    )


def total_bytes(found: DataFrame) -> int:
    return found.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]


def count_from_footers(spark: SparkSession, path: str) -> DataFrame:
    """``COUNT(*)`` of Parquet files out of their footers alone: no column is read.

    The session's version-2 reader pushes the aggregate into the scan; the settings hold
    for this plan only.
    """
    chosen = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {key: spark.conf.get(key) for key in chosen}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    try:
        counted = spark.read.parquet(path).agg(F.count("*").alias("rows"))
        counted._jdf.queryExecution().executedPlan()  # planned now, under these settings
        return counted
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def write_for_lookup(df: DataFrame, path: str, key: str, parts: list[str], distinct: int = 1_000_000, mode: str = "errorifexists") -> None:
    """Write Parquet in which a look-up by ``key`` skips files, row groups and pages.

    Rows lie in ranges of the key, so that least and largest values part the files, and
    each row group has a Bloom filter for about ``distinct`` values of the key, which tells
    of keys inside a range that are not there.
    """
    ordered = df.repartitionByRange(*parts, key).sortWithinPartitions(*parts, key)
    writer = ordered.write.mode(mode).partitionBy(*parts) if parts else ordered.write.mode(mode)
    (
        writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )
