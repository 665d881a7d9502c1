"""Row numbers, top rows per group, and ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.functions import times
from tradelake.operators.indexing import index_rows


def order_by(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending sort with nulls last."""
    return df.orderBy(*[F.col(key).asc_nulls_last() for key in keys])


def top_in(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str = "rnk") -> DataFrame:
    """The first ``n`` rows per group.

    The filter on the rank lets Spark cut every group to ``n`` rows per task
    before the shuffle, so a group of any size sends little. Spark does so up to
    a threshold; beyond it the rows are ranked without a window.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        ranked = rank_in(df, keys, order, rank)
        return ranked.filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("int"))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def rank_in(
    df: DataFrame, keys: list[str], order: list[Column], rank: str = "rnk", path: str | None = None
) -> DataFrame:
    """Row number of every row in its group, for groups of any size.

    A window would bring a whole group into one task. Here the rows get their
    position in one range-partitioned sort, and the group's first position,
    found by an aggregate, is subtracted.
    """
    indexed, _ = index_rows(df, [*[F.col(key) for key in keys], *order], "_at", path)
    starts = indexed.groupBy(*[F.col(key).alias(f"_{key}") for key in keys]).agg(
        F.min("_at").alias("_start")
    )
    same = F.lit(True)
    for key in keys:
        same = same & indexed[key].eqNullSafe(starts[f"_{key}"])
    return (
        indexed.join(starts, same)
        .withColumn(rank, F.col("_at") - F.col("_start") + 1)
        .select(*df.columns, rank)
    )


HOUR_KEYS = ["symbol", "type", "_hour"]


def by_dollars() -> list[Column]:
    """Largest first; ``trans_id`` settles ties, so that the result is one and the same."""
    return [F.col("dollar_amount").desc_nulls_last(), F.col("trans_id").asc()]


def _named_hour(df: DataFrame) -> DataFrame:
    bucket = times.hour_text(times.event_time("_hour"))
    return df.withColumn("HourlyBucket", bucket).drop("_hour")


def top_trades_per_hour(trades: DataFrame, n: int = 1) -> DataFrame:
    """The largest trades of each symbol, side and event hour."""
    hourly = trades.withColumn("_hour", times.hour_start("transaction_ts"))
    best = _named_hour(top_in(hourly, HOUR_KEYS, by_dollars(), n))
    year = times.year_text(times.event_time("transaction_ts"))
    return order_by(best.withColumn("year", year), "HourlyBucket", "symbol", "type", "rnk")


def rank_trades_per_hour(trades: DataFrame) -> DataFrame:
    """Every trade with its place by dollars within symbol, side and event hour."""
    hourly = trades.withColumn("_hour", times.hour_start("transaction_ts"))
    return _named_hour(rank_in(hourly, HOUR_KEYS, by_dollars()))
