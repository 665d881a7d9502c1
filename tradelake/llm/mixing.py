"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. A document takes part with a target number of
copies: the whole part is certain, the fraction is its inclusion probability. The
documents of a source are ranked by the odds of a random number over the odds of
that probability, and the lowest ranks are taken until the words reach the target.

Null and empty texts have size 0; a null source is a source of its own and comes
last. Repeated rows share their random number and are taken or left together. An
empty table gives an empty result. Reruns agree, as the random numbers depend on
the id and the seed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradelake.llm.common import apart, stored, uniform, word_count

WEIGHTS = (5.0, 2.0, 1.0)
BUCKETS = 4096


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` of a table with one row ``source, source_size`` per source.

    ``share`` of all words is dealt by weight. A source stops at ``most`` times its
    size and the excess is dealt again; the result is the level at which the
    sources below their limit share what the limited ones leave. The windows run
    over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    limited = (
        sizes.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("level", F.col("limit") / F.col("weight"))
    )
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # The level that this source and all with a higher limit would share.
    shared = limited.withColumn("shared", (total - spent) / left)
    # It falls from the first source on that it does not fill, so the largest such value holds.
    level = F.max(F.when(F.col("shared") <= F.col("level"), F.col("shared"))).over(everything)
    target = F.least(F.col("limit"), F.coalesce(level, F.col("level")) * F.col("weight"))
    return shared.select("source", "source_size", target.cast("double").alias("target"))


def plan(docs: DataFrame, doc_id: str, source: str, text: str, seed: str, share: float, most: float) -> DataFrame:
    """Per source: ``source, source_size, target``, whole copies and the last rank taken."""
    rows = stored(
        docs.select(
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            uniform(F.lit(seed), F.col(doc_id).cast("string")).alias("u"),
        ),
        "sizes",
    )
    sums = stored(
        targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, most), "targets"
    )
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(copies).cast("long")
    sums = (
        sums.withColumn("whole", whole)
        .withColumn("chance", copies - whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    ranked = (
        rows.join(sums.select(F.col("source").alias("s"), "chance", "rest"), F.col("source").eqNullSafe(F.col("s")))
        .where("size > 0 and chance > 0")
        .select("source", "size", "rest", rank(F.col("u"), F.col("chance")).alias("rank"))
        .withColumn("bucket", F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS).cast("int"))
    )
    # Sums by bucket of ranks come first, so that only one bucket of a source is sorted.
    filled = ranked.groupBy("source", "bucket", "rest").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("bucket")
    last = (
        filled.withColumn("before", F.sum("words").over(up_to) - F.col("words"))
        .where("before <= rest and before + words > rest")
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before")
    )
    inside = ranked.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    # Rows of equal rank stand or fall together.
    peers = Window.partitionBy("source").orderBy("rank")
    cut = (
        inside.groupBy("source", "rest", "before", "rank")
        .agg(F.sum("size").alias("size"))
        .withColumn("words", F.col("before") + F.sum("size").over(peers))
        .withColumn("nearer", F.col("words") - F.col("rest") <= F.col("rest") - (F.col("words") - F.col("size")))
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("nearer"), F.col("rank"))).alias("cut"),
            F.min("rank").alias("first"),
        )
        .select(F.col("source").alias("s"), F.coalesce("cut", F.col("first") * F.lit(1 - 1e-15)).alias("cut"))
    )
    return stored(
        sums.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
        .select("source", "source_size", "target", "whole", "chance", F.coalesce("cut", F.lit(float("inf"))).alias("cut")),
        "mix",
    )


def rank(u: Column, chance: Column) -> Column:
    """Odds of the random number over the odds of inclusion."""
    return (u / (1 - u)) / (chance / (1 - chance))


def mix(
    docs: DataFrame, keep: list[str], doc_id: str = "doc_id", source: str = "source", text: str = "text",
    seed: str = "mix", share: float = 1.5, most: float = 2.0,
) -> DataFrame:
    """``keep`` columns of each row with ``size, source_size, target, copies, taken``.

    A kept column with the name of one of these gets ``_in`` behind it.
    """
    results = ["size", "source_size", "target", "copies", "taken"]
    rows, named = apart(docs, keep, results, key=source, name=doc_id, text=text)
    sources = plan(docs, doc_id, source, text, seed, share, most).withColumnRenamed("source", "__source")
    u = uniform(F.lit(seed), F.col("name").cast("string"))
    more = (F.col("chance") > 0) & (rank(F.col("u"), F.col("chance")) <= F.col("cut"))
    return named(
        rows.withColumns({"size": word_count(F.col("text")), "u": u}).drop("name", "text")
        .join(sources, F.col("key").eqNullSafe(F.col("__source")))
        .withColumn("copies", F.col("whole") + more.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
