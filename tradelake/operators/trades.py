"""Trade rows: coercion, event-time columns, display and delivery summary."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradelake.functions import records, times
from tradelake.functions.text import partition_path
from tradelake.schemas import PROCESSED_COLUMNS, PROCESSED_PARTITIONS, TRADE


def _converted(name: str, kind: str) -> Column:
    text = F.btrim(F.col(name), F.lit(" \t\n\r\x0b\x0c"))
    if kind == "bigint":
        return F.when(text.rlike(records.INT_TEXT), text.try_cast("bigint"))
    if kind == "double":
        plain = F.regexp_replace(F.lower(text), "^[+-]nan$", "nan")
        return F.when(text.rlike(records.FLOAT_TEXT), plain.try_cast("double"))
    return F.col(name)


def _checked(df: DataFrame) -> DataFrame:
    """Text rows with their converted numbers, and whether all of those converted."""
    numbers = {f"_{name}": _converted(name, kind) for name, kind in records.NUMBERS.items()}
    good = F.lit(True)
    for name in numbers:
        good = good & F.col(name).isNotNull()
    return df.withColumns(numbers).withColumn("_good", good)


def _typed(checked: DataFrame) -> DataFrame:
    return checked.filter("_good").select(
        *[F.col(f"_{n}" if n in records.NUMBERS else n).alias(n) for n in TRADE.names]
    )


def coerce_trades(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the text rows with a number field that does not convert."""
    checked = _checked(df)
    return _typed(checked), checked.filter("NOT _good").select(*df.columns)


def trade_json() -> Column:
    """The trade as one JSON object with the fields in schema order."""
    return F.to_json(F.struct(*TRADE.names))


# The fields of the display line.
SHOWN = ["trans_id", "symbol", "price", "amount", "type"]


def format_events(df: DataFrame, value: str = "value") -> DataFrame:
    """One display line per record plus the full JSON; absent fields show as None."""
    # Read as text, numbers keep the digits they were sent with.
    fields = F.from_json(value, ", ".join(f"`{name}` string" for name in SHOWN))
    shown = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col("_fields")[name], F.lit("None"))) for name in SHOWN
    ]
    line = F.concat(F.lit("Event: "), F.concat_ws(" ", *shown))
    return (
        df.withColumn("_fields", fields)
        .withColumn("line", line)
        .withColumn("full_event", F.concat(F.lit("Full event: "), F.col(value)))
        .drop("_fields")
    )


def refine(df: DataFrame, *kept: str) -> DataFrame:
    """Event-time text and partition columns from ``transaction_ts``; the latter is dropped.

    ``kept`` names further columns to keep. Rows without a symbol or a usable time have no partition and are left out;
    :func:`unrefined` counts them.
    """
    return _with_partitions(df).filter(_has_partition()).select(*PROCESSED_COLUMNS, *PROCESSED_PARTITIONS, *kept)


def unrefinable(df: DataFrame) -> DataFrame:
    """The rows :func:`refine` leaves out, with their own columns."""
    return _with_partitions(df).filter(~_has_partition()).select(*df.columns)


def unrefined(df: DataFrame) -> DataFrame:
    """Number of rows :func:`refine` leaves out."""
    return unrefinable(df).agg(F.count("*").alias("dropped"))


def _with_partitions(df: DataFrame) -> DataFrame:
    return df.withColumn("_ts", times.event_time("transaction_ts")).withColumns(
        {"transaction_date": times.iso_text(F.col("_ts")), **times.number_parts(F.col("_ts"))}
    )


def _has_partition() -> Column:
    return F.col("symbol").isNotNull() & F.col("_ts").isNotNull()


def group_keys(refined: DataFrame) -> DataFrame:
    """Rows per output partition."""
    return refined.groupBy(*PROCESSED_PARTITIONS).agg(F.count("*").alias("rows"))


def partition_paths(refined: DataFrame, root: str) -> DataFrame:
    """The distinct partition folders a run fills."""
    return group_keys(refined).select(partition_path(root, PROCESSED_PARTITIONS).alias("path"))


def with_clocks(df: DataFrame, arrival: str = "arrival_ts") -> DataFrame:
    """Arrival and event hour side by side, and whether the record came in a later hour."""
    return df.withColumns(
        {
            "arrival_hour": times.hour_text(F.col(arrival)),
            "event_hour": times.hour_text(times.event_time("transaction_ts")),
        }
    ).withColumn("late", F.col("arrival_hour") > F.col("event_hour"))


def delivery_summary(df: DataFrame, sample: int = 10) -> DataFrame:
    """One row for a run over text rows: sent, refused, and the first trades sent as JSON."""
    checked = _checked(df)
    counts = checked.agg(F.count_if("_good").alias("sent"), F.count_if(~F.col("_good")).alias("errors"))
    entry = F.struct("trans_id", trade_json().alias("event"))
    first = first_rows(_typed(checked), ["trans_id"], sample).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["event"]).alias("events_sample")
    )
    return counts.select("*", first.scalar().alias("events_sample"))


def delivered_ids(typed: DataFrame) -> DataFrame:
    """The ids of all trades sent; a trade drawn twice is listed twice."""
    return typed.select("trans_id")


def deliver_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, float]:
    """Coerce text rows and write the good ones, counting both kinds in the same pass."""
    seen = Observation()
    counts = [F.count_if("_good").alias("sent"), F.count_if(~F.col("_good")).alias("errors")]
    start = time.monotonic()
    write(_typed(_checked(df).observe(seen, *counts)))
    elapsed = time.monotonic() - start
    found = seen.get
    rate = found["sent"] / elapsed if elapsed > 0 else 0.0
    return {**found, "elapsed": round(elapsed, 2), "rate": rate}


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in an order: each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)
