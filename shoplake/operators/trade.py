"""DWS/ADS trade metrics over cleaned orders (``dwd_order`` output).

All are single ``groupBy().agg()`` plans: Spark computes partial aggregates
map-side, so a hot day or payment method never reaches one reducer as raw
rows.  Shares use a window over the *aggregated* rows (one row per group, a
bounded size) instead of a second scan for the denominator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.columns import money_avg, money_sum, percent, to_money
from shoplake.functions.labels import VALID_STATUSES


def daily_trade(dwd: DataFrame) -> DataFrame:
    """A1: per day orders, GMV, discount, revenue, AOV and buyers."""
    return dwd.groupBy("order_date").agg(
        F.count("order_id").alias("order_cnt"),
        money_sum("order_amount").alias("total_gmv"),
        money_sum("discount_amount").alias("total_discount"),
        money_sum("actual_amount").alias("total_revenue"),
        money_avg("actual_amount").alias("avg_order_value"),
        F.count("user_id").alias("buyer_cnt"),
        F.count_distinct("user_id").alias("distinct_buyer_cnt"),
    )


def daily_payment(dwd: DataFrame) -> DataFrame:
    """A2: per day and payment method."""
    return dwd.groupBy("order_date", "payment_method").agg(
        F.count("order_id").alias("order_cnt"),
        money_sum("actual_amount").alias("total_amount"))


def top_gmv_days(dwd: DataFrame, k: int = 5) -> DataFrame:
    """The k days with the highest GMV (ties: earlier day first)."""
    return (daily_trade(dwd)
            .orderBy(F.col("total_gmv").desc(), F.col("order_date").asc()).limit(k))


def payment_share(dwd: DataFrame) -> DataFrame:
    """A4: orders per payment method and their share of all valid orders."""
    per_method = dwd.groupBy("payment_method").agg(F.count("order_id").alias("order_cnt"))
    total = F.sum("order_cnt").over(Window.partitionBy())
    return per_method.select("payment_method", "order_cnt",
                             percent("order_cnt", total, 1).alias("pct"))


def kpi_dashboard(dwd: DataFrame) -> DataFrame:
    """One KPI row."""
    return dwd.agg(
        F.count("order_id").alias("total_orders"),
        money_sum("actual_amount").alias("total_revenue"),
        money_avg("actual_amount").alias("avg_order_value"),
        F.count("user_id").alias("total_buyers"),
        F.count_distinct("user_id").alias("distinct_buyers"))


def order_amount_stats(orders: DataFrame, statuses: Sequence[str] = VALID_STATUSES) -> DataFrame:
    """Amount statistics over orders in the given statuses (no amount test)."""
    return (orders.where(F.col("order_status").isin(*statuses))
            .agg(F.count(F.lit(1)).alias("order_cnt"),
                 money_sum("actual_amount").alias("total_amount"),
                 money_avg("actual_amount").alias("avg_amount"),
                 F.max(to_money("actual_amount")).cast("double").alias("max_amount")))


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per status."""
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("cnt"))
