"""The cleaned order layer on disk, partitioned by day.

Jobs that look at chosen days need not scan all orders.  The layer is written
with one folder per ``order_date``; a join with a table of days prunes the
folders at run time (dynamic partition pruning: the days that pass the other
side's filters become the partition filter of the scan).  Lines of these orders
are found by a join on ``order_id``; where the line table is large, Spark puts a
Bloom filter of the chosen order ids under its scan (``spark.sql.optimizer.runtime.
bloomFilter``), so most lines never reach the shuffle.

Writing rebalances by day: AQE joins small days into one task and splits a day
that holds a large share of the orders over several, so no task writes a hot
day alone and no day is scattered over all tasks.  Orders without a date are in
a folder of their own and belong to no day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.functions.columns import money_sum
from shoplake.operators.clean import weekend_flag
from shoplake.sources import commits


def write_order_layer(dwd: DataFrame, path: str) -> str:
    """P13 on disk: replace the layer at ``path``; the old version is readable until the new one is complete."""
    return commits.refresh(dwd.sparkSession, path, lambda folder: (
        dwd.hint("rebalance", "order_date").write.partitionBy("order_date").parquet(folder)))


def read_order_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The layer with the columns of the orders it was written from (``schema``); it may be empty."""
    return spark.read.schema(schema).parquet(commits.resolve(spark, path))


def calendar(dwd: DataFrame) -> DataFrame:
    """One row per day between the first and the last order: ``order_date``, ``is_weekend``, ``month``."""
    span = dwd.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b")).where("a is not null")
    days = span.select(F.explode(F.sequence("a", "b")).alias("order_date"))
    return days.select("order_date", weekend_flag().alias("is_weekend"), F.date_format("order_date", "yyyy-MM").alias("month"))


def orders_of_days(layer: DataFrame, days: DataFrame) -> DataFrame:
    """The orders of the days (``order_date`` rows, each day once)."""
    return layer.join(days.select("order_date"), "order_date")


def day_totals(layer: DataFrame, days: DataFrame, details: DataFrame) -> DataFrame:
    """J3 over chosen days: per day its orders, revenue and order lines; days without orders give no row."""
    orders = orders_of_days(layer, days)
    lines = (details.select("order_id").join(orders.select("order_id", "order_date"), "order_id")
             .groupBy("order_date").agg(F.count(F.lit(1)).alias("line_cnt")))
    totals = orders.groupBy("order_date").agg(F.count("order_id").alias("order_cnt"), money_sum("actual_amount").alias("total_revenue"))
    return totals.join(lines, "order_date", "left").select(
        "order_date", "order_cnt", "total_revenue", F.coalesce("line_cnt", F.lit(0)).alias("line_cnt"))
