"""Dense row positions, exact sampling and even chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.session import run_dir

# About 10 MB of file names and offsets; longer lists are joined by a shuffle.
BROADCAST_FILES = 50_000


def index_rows(
    df: DataFrame,
    order: list[Column] | None = None,
    name: str = "row_index",
    path: str | None = None,
) -> tuple[DataFrame, int]:
    """Add each row's position, from 0, and return the number of rows too.

    The rows are written once to the shared folder, sorted by range if an order
    is given. A row is then known by its file and place in it, which stays true
    when tasks are repeated, and its position is the rows in earlier files plus
    that place. Only the file list, one row per written file, is gathered.
    The result reads that table, in ``path`` if given, for the caller to delete.
    """
    spark = df.sparkSession
    path = path or run_dir(spark, "indexed")
    # The running id parts rows with equal keys, so a hot key spans many ranges.
    rows = df.orderBy(*order, F.monotonically_increasing_id()) if order else df
    rows.write.parquet(path)

    file = F.col("_metadata.file_name")
    stored = spark.read.schema(df.schema).parquet(path)
    sizes = (
        stored.groupBy(file.alias("file"))
        .agg(F.count("*").alias("rows"))
        # part-<task>-<job id>-c<file of the task>.snappy.parquet
        .withColumn("task", F.regexp_extract("file", r"^part-(\d+)", 1).cast("long"))
        .withColumn("part", F.regexp_extract("file", r"-c(\d+)\.", 1).cast("long"))
        .orderBy("task", "part")
        .collect()
    )
    firsts, before = [], 0
    for size in sizes:
        firsts.append((size["file"], before))
        before += size["rows"]
    starts = spark.createDataFrame(firsts, "_file string, _first bigint")
    if len(firsts) <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    indexed = (
        stored.withColumns({"_file": file, "_at": F.col("_metadata.row_index")})
        .join(starts, "_file")
        .withColumn(name, F.col("_first") + F.col("_at"))
        .select(*df.columns, name)
    )
    return indexed, before


def sample_exact(
    df: DataFrame,
    n: int,
    seed: int = 0,
    order: list[Column] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Exactly ``n`` rows drawn uniformly with replacement; an empty input gives none.

    Draw ``i`` takes the position that a hash of seed and ``i`` names, so a
    repeated task draws the same. Both sides meet in an equi-join on the position.
    """
    indexed, rows = index_rows(df, order, path=path)
    if rows == 0:
        return indexed.withColumn("draw", F.lit(None).cast("bigint")).drop("row_index")
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.col("draw").cast("string")).cast("binary"))
    place = F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint") % F.lit(rows)
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw").withColumn("row_index", place)
    return draws.join(indexed, "row_index").select("draw", *df.columns)


def chunk(
    df: DataFrame, k: int, order: list[Column] | None = None, path: str | None = None
) -> DataFrame:
    """Number the rows into chunks of ``ceil(rows / k)``, the last one shorter."""
    indexed, rows = index_rows(df, order, path=path)
    size = max(1, -(-rows // k))
    return indexed.withColumn("chunk", F.expr(f"row_index div {size}L"))
