"""Product analysis: category and brand sales, rankings, profit and price views.

Sales over order lines are first reduced to one row per product (partial
aggregation map-side, so a hot product never travels as raw lines), then
joined with the product dimension, then rolled up.  Line profit
``subtotal - quantity * cost`` sums per product to
``sum(subtotal) - cost * sum(quantity)`` exactly (DECIMAL arithmetic), so the
per-product reduction loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.columns import money_avg, to_double, to_money
from shoplake.plans.joins import dim_join


def restrict_to_orders(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Keep lines whose order is in ``orders`` (a semi join; no columns added)."""
    return details.join(orders.select("order_id"), "order_id", "left_semi")


def detail_products(details: DataFrame, products: DataFrame,
                    broadcast: bool = True) -> DataFrame:
    """Order lines LEFT JOIN products."""
    dims = products.select("product_id", "category", "brand",
                           to_double(to_money("cost")).alias("cost"))
    lines = details.select("order_id", "product_id", "quantity",
                           to_double(to_money("subtotal")).alias("subtotal"))
    return dim_join(lines, dims, "product_id", broadcast=broadcast)


def product_sales(details: DataFrame) -> DataFrame:
    """Per-product line count, units, GMV and the parts of the profit sum."""
    sub = to_money("subtotal")
    both = sub.isNotNull() & F.col("quantity").isNotNull()
    return details.groupBy("product_id").agg(
        F.count("detail_id").alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum(sub).alias("gmv"),
        F.sum(F.when(both, sub)).alias("pair_gmv"),
        F.sum(F.when(both, F.col("quantity"))).alias("pair_units"),
        F.count(F.when(both, F.lit(1))).alias("pairs"))


def sales_with_dims(details: DataFrame, products: DataFrame, broadcast: bool = True) -> DataFrame:
    """Per-product sales joined to category, brand and cost, with the exact product profit.

    The table category and brand results roll up; pass it as ``sales`` to
    reuse one computation for several results.
    """
    dims = products.select("product_id", "category", "brand", to_money("cost").alias("cost"))
    per_product = product_sales(details)
    joined = dim_join(per_product, dims, "product_id", broadcast=broadcast)
    profit = F.when(F.col("pairs") > 0,
                    F.col("pair_gmv") - F.col("cost") * F.col("pair_units"))
    return joined.withColumn("profit", profit)


def category_sales(details: DataFrame | None, products: DataFrame | None,
                   orders: DataFrame | None = None, broadcast: bool = True,
                   sales: DataFrame | None = None) -> DataFrame:
    """Per category products sold, lines, units, GMV, profit and margin.

    Pass ``orders`` (e.g. valid orders) to count only their lines (D10).
    """
    if sales is None:
        if orders is not None:
            details = restrict_to_orders(details, orders)
        sales = sales_with_dims(details, products, broadcast)
    agg = sales.groupBy("category").agg(
        F.count_distinct("product_id").alias("product_cnt"),
        F.sum("lines").alias("sold_qty"),
        F.sum("units").alias("units_sold"),
        F.sum("gmv").cast("double").alias("total_gmv"),
        F.sum("profit").cast("double").alias("total_profit"))
    margin = F.round(F.try_divide(F.col("total_profit"), F.col("total_gmv")) * F.lit(100), 1)
    return agg.withColumn("profit_margin_pct", margin)


def category_catalog(products: DataFrame) -> DataFrame:
    """Products, mean price and mean unit profit per category."""
    return products.groupBy("category").agg(
        F.count("product_id").alias("product_cnt"),
        money_avg("price").alias("avg_price"),
        money_avg(to_money("price") - to_money("cost")).alias("avg_profit_per_item"))


def brand_sales(details: DataFrame | None, products: DataFrame | None,
                broadcast: bool = True, sales: DataFrame | None = None) -> DataFrame:
    """Sales and products sold per (category, brand)."""
    if sales is None:
        sales = sales_with_dims(details, products, broadcast)
    return sales.groupBy("category", "brand").agg(
        F.sum("gmv").cast("double").alias("brand_sales"),
        F.count_distinct("product_id").alias("brand_products"))


def brand_top3(details: DataFrame | None, products: DataFrame | None, k: int = 3,
               broadcast: bool = True, sales: DataFrame | None = None) -> DataFrame:
    """The k best-selling brands per category (ties by brand name).

    ``row_number <= k`` over a category partition is planned with a
    ``WindowGroupLimit`` that trims each partition before the final window.
    """
    w = Window.partitionBy("category").orderBy(F.col("brand_sales").desc(), F.col("brand").asc())
    return (brand_sales(details, products, broadcast, sales)
            .withColumn("brand_rank", F.row_number().over(w))
            .where(F.col("brand_rank") <= k))


def brand_catalog(products: DataFrame) -> DataFrame:
    """Products and mean price per (category, brand)."""
    return products.groupBy("category", "brand").agg(
        F.count("product_id").alias("product_cnt"),
        money_avg("price").alias("avg_price"))


def high_profit_top(products: DataFrame, k: int = 20) -> DataFrame:
    """The k products with the highest unit profit (ties by product id)."""
    unit_profit = to_money("price") - to_money("cost")
    w = Window.orderBy(F.col("profit_per_item").desc(), F.col("product_id").asc())
    return (products.select(
                "product_id", "product_name", "category", "brand",
                to_double(to_money("price")).alias("price"),
                to_double(to_money("cost")).alias("cost"),
                unit_profit.cast("double").alias("profit_per_item"),
                F.round(F.try_divide(unit_profit.cast("double"), to_money("price").cast("double"))
                        * F.lit(100), 1).alias("margin"))
            .withColumn("profit_rank", F.row_number().over(w))
            .where(F.col("profit_rank") <= k))


def price_distribution(products: DataFrame) -> DataFrame:
    """Count, min / mean / max price and mean unit margin per category."""
    price = to_money("price")
    return products.groupBy("category").agg(
        F.count("product_id").alias("product_cnt"),
        F.min(price).cast("double").alias("min_price"),
        money_avg(price).alias("avg_price"),
        F.max(price).cast("double").alias("max_price"),
        money_avg(price - to_money("cost")).alias("avg_margin"))


def category_order_sales(orders: DataFrame, products: DataFrame,
                         broadcast: bool = True) -> DataFrame:
    """A16 + J8: per category products, orders and GMV for orders that carry a ``product_id``.

    The fallback the reference uses when no order lines exist; the business
    order table declares no ``product_id``, so it applies only to such feeds.
    """
    dims = products.select("product_id", "category")
    joined = dim_join(orders, dims, "product_id", broadcast=broadcast)
    return joined.groupBy("category").agg(
        F.count_distinct("product_id").alias("product_cnt"),
        F.count("order_id").alias("order_cnt"),
        F.sum(to_money("actual_amount")).cast("double").alias("total_gmv"))
