"""Row positions, samples, chunks and rankings, also with one hot key."""

from __future__ import annotations

from conftest import SF, plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradelake.operators import indexing, ranking
from tradelake.plans.inputs import trades


def skewed(spark, n=6000):
    """A third of the rows share one key, and half of those one order value too."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    value = F.when(F.col("id") % 6 == 0, F.lit(5)).otherwise(F.col("id") % 11)
    return spark.range(n).select("id", key.alias("key"), value.cast("int").alias("value"))


def test_positions_are_dense_and_follow_the_order(spark):
    rows, n = indexing.index_rows(skewed(spark), [F.col("value"), F.col("id").desc()])
    want = skewed(spark).withColumn(
        "want", F.row_number().over(Window.orderBy("value", F.col("id").desc())) - 1
    )
    assert n == 6000
    assert rows.join(want, "id").filter("row_index <> want").isEmpty()


def test_a_hot_order_key_spans_tasks(spark, folder):
    frame = skewed(spark).withColumn("one", F.lit(1))
    rows, n = indexing.index_rows(frame, [F.col("one")], path=folder)
    assert n == 6000
    assert len(spark.read.parquet(folder).inputFiles()) > 3
    assert rows.select("row_index").distinct().count() == 6000
    assert rows.agg(F.min("row_index"), F.max("row_index")).first() == (0, 5999)


def test_positions_without_order_and_without_rows(spark):
    rows, n = indexing.index_rows(skewed(spark).repartition(5))
    assert n == 6000 and rows.agg(F.countDistinct("row_index")).first()[0] == 6000
    assert indexing.index_rows(skewed(spark).limit(0))[1] == 0


def test_sample_is_exact_repeatable_and_with_replacement(spark):
    rows = trades(spark, SF).select("trans_id")
    order = [F.col("trans_id")]
    one = indexing.sample_exact(rows, 3000, 1, order)
    again = indexing.sample_exact(rows, 3000, 1, order)
    other = indexing.sample_exact(rows, 3000, 2, order)
    assert one.count() == 3000
    assert one.exceptAll(again).isEmpty() and not one.exceptAll(other).isEmpty()
    drawn = one.select("trans_id").distinct().count()
    assert 900 < drawn < 1000  # 1000 rows, 3000 draws: about 950 are hit
    assert indexing.sample_exact(rows.limit(0), 5).count() == 0


def test_chunks(spark):
    sizes = lambda k: [
        r["count"] for r in indexing.chunk(spark.range(103), k).groupBy("chunk").count().orderBy("chunk").collect()
    ]
    assert sizes(10) == [11] * 9 + [4]
    assert sizes(1) == [103]
    assert sizes(500) == [1] * 103


def test_full_rank_with_null_and_hot_keys(spark):
    frame = skewed(spark).withColumn("key", F.when(F.col("key") != "k5", F.col("key")))
    order = [F.col("value").desc(), F.col("id")]
    got = ranking.rank_in(frame, ["key"], order)
    want = frame.withColumn("rnk", F.row_number().over(Window.partitionBy("key").orderBy(*order)).cast("long"))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    assert "Window" not in plan_of(got)


def test_top_rows_are_cut_before_the_shuffle(spark):
    plan = plan_of(ranking.top_trades_per_hour(trades(spark, SF)))
    assert plan.count("WindowGroupLimit") == 2
    partial = plan.rindex("WindowGroupLimit")
    assert plan.rindex("Exchange hashpartitioning") < partial


def test_order_puts_nulls_last(spark):
    frame = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3)], "k string, v int")
    assert [r.v for r in ranking.order_by(frame, "k").collect()] == [3, 2, 1]


def test_many_top_rows_are_ranked_without_a_window(spark):
    order = [F.col("value").desc(), F.col("id")]
    few = ranking.top_in(skewed(spark), ["key"], order, n=1000)
    many = ranking.top_in(skewed(spark), ["key"], order, n=1500)
    assert "WindowGroupLimit" in plan_of(few) and "Window" not in plan_of(many)
    assert few.dtypes == many.dtypes
    assert many.filter("rnk <= 1000").exceptAll(few).isEmpty()
    assert many.filter("key = 'hot'").count() == 1500
