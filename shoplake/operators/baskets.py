"""Basket analysis: basket sizes and co-purchased product pairs.

Scale notes
-----------
* Lines are first reduced to ``(order_id, product_id, lines)``: a product on
  several lines of one order becomes one row with a weight, and a hot order
  is spread over tasks by product during that reduction.
* The pair self-join is salted per order: an order with ``n`` distinct
  products gets ``ceil(n / split_above)`` salt buckets.  Its left rows go to
  the bucket ``hash(product) mod buckets`` and its right rows are copied to
  every bucket, so each pair is produced exactly once and a huge basket is
  spread over many tasks instead of one.  Ordinary orders get one bucket and
  are not copied.
* Only orders above ``split_above`` enter the bucket lookup.  They are copied
  to ``LOOKUP_PARTS`` parts and lines look them up by (order, part of the
  product's hash), so a hot order is spread over that many tasks before any copy is made.
* Partitions of the reduction, the join and the pair count follow the numbers of
  lines and pairs (``parts_for``), and pairs are counted where they are brought
  together: a task's sorts and hash tables keep their size as tables grow.
* The pair count ``sum(lines_a * lines_b)`` equals the count of line pairs the
  reference produces (D11), without materialising the line pairs.
* ``top_pairs`` finds the k greatest pairs without counting all: products enter
  by falling bound of what any pair with them can reach, until the k-th count
  beats the bounds of all products left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.session import parts_for, stored_table

LINES_PER_PART = 500_000
PAIRS_PER_PART = 1_000_000


def basket_items(details: DataFrame) -> DataFrame:
    """``(order_id, product_id, lines)``: the basket in long form."""
    lines = details.where(F.col("product_id").isNotNull()).select("order_id", "product_id")
    return (lines.repartition(parts_for(details.count(), LINES_PER_PART), "order_id", "product_id")
            .groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("lines")))


def baskets(details: DataFrame, min_size: int = 2) -> DataFrame:
    """Orders with at least ``min_size`` product lines and their size.

    The size is the number of lines with a product (what the reference's
    ``size(collect_list(product_id))`` gives); the list itself is not built,
    a basket's content is ``basket_items``.
    """
    return (details.groupBy("order_id")
            .agg(F.count("product_id").cast("int").alias("basket_size"))
            .where(F.col("basket_size") >= min_size))


def multi_product_orders(details: DataFrame, min_size: int = 2) -> DataFrame:
    """Number of orders with at least ``min_size`` product lines."""
    return baskets(details, min_size).agg(F.count(F.lit(1)).alias("order_cnt"))


LOOKUP_PARTS = 64


def co_purchase(details: DataFrame, distinct_per_order: bool = False,
                split_above: int | None = 2048) -> DataFrame:
    """J4 + A21: ``(product_a < product_b, co_count)`` over all orders.

    ``distinct_per_order=True`` counts each pair once per order instead of
    once per line pair.  ``split_above=None`` disables salting (then AQE's
    skew-join handling is the only protection against a huge basket).
    """
    return _count_pairs(stored_table(_weighted_items(details, distinct_per_order), "pair-items"), split_above)


def pair_parts(sizes: DataFrame) -> int:
    """Partitions for the pairs of baskets of ``n`` products: they follow the rows that meet and the pairs they make."""
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                      F.coalesce(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2), F.lit(0.0)).alias("pairs")).first()
    return max(parts_for(total["rows"], LINES_PER_PART), parts_for(int(total["pairs"]), PAIRS_PER_PART))


def _weighted_items(details: DataFrame, distinct_per_order: bool) -> DataFrame:
    weight = F.lit(1).cast("long") if distinct_per_order else F.col("lines")
    return basket_items(details).select("order_id", "product_id", weight.alias("w"))


def _count_pairs(items: DataFrame, split_above: int | None, left_out: str | None = None) -> DataFrame:
    """Pair counts of ``(order_id, product_id, w)`` rows; pairs of two rows that both have ``left_out`` set are not made."""
    flag = F.col(left_out) if left_out else F.lit(False)
    items = items.select("order_id", "product_id", "w", flag.alias("out"))
    if split_above is None:
        left = items.select("order_id", F.col("product_id").alias("product_a"),
                            F.col("w").alias("wa"), F.col("out").alias("oa"))
        right = items.select("order_id", F.col("product_id").alias("product_b"),
                             F.col("w").alias("wb"), F.col("out").alias("ob"))
        pairs = left.join(right, "order_id")
    else:
        # an order has at most as many rows as there are products
        sizes = (items.select("order_id").repartition(parts_for(items.count(), LINES_PER_PART), "order_id")
                 .groupBy("order_id").agg(F.count(F.lit(1)).alias("n")))
        parts = pair_parts(sizes)
        hot = (sizes.where(F.col("n") > split_above)
               .select("order_id", F.ceil(F.col("n") / F.lit(split_above)).cast("int").alias("buckets"),
                       F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_PARTS - 1))).alias("part")))
        part = F.pmod(F.xxhash64("product_id"), F.lit(LOOKUP_PARTS)).cast("int")
        salted = (items.withColumn("part", part).join(hot, ["order_id", "part"], "left")
                  .withColumn("buckets", F.coalesce("buckets", F.lit(1))))
        left = salted.select(
            "order_id", F.col("product_id").alias("product_a"), F.col("w").alias("wa"), F.col("out").alias("oa"),
            F.pmod(F.xxhash64(F.lit(1), "product_id"), F.col("buckets")).cast("int").alias("salt"))
        right = salted.select(
            "order_id", F.col("product_id").alias("product_b"), F.col("w").alias("wb"), F.col("out").alias("ob"),
            F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("salt"))
        pairs = (left.repartition(parts, "order_id", "salt")
                 .join(right.repartition(parts, "order_id", "salt").hint("merge"), ["order_id", "salt"]))
    pairs = (pairs.where((F.col("product_a") < F.col("product_b")) & ~(F.col("oa") & F.col("ob")))
             .select("product_a", "product_b", "wa", "wb"))
    if split_above is not None:
        pairs = pairs.repartition(parts, "product_a", "product_b")
    return (pairs.groupBy("product_a", "product_b")
            .agg(F.sum(F.col("wa") * F.col("wb")).alias("co_count")))


SEED_PRODUCTS = 1000
GROWTH = 8


def pair_bounds(items: DataFrame) -> DataFrame:
    """``(product_id, bound)``: no pair with the product counts more than ``bound``.

    In an order of total weight s and greatest weight m, a product of weight w
    adds w * w_b to a pair with b, and w_b is at most m and at most s - w.
    """
    orders = stored_table(items.groupBy("order_id").agg(
        F.max("w").alias("top"), F.sum("w").alias("total"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("order_id", "top", "total"), "pair-orders")
    return (items.join(orders, "order_id").groupBy("product_id")
            .agg(F.sum(F.col("w") * F.least(F.col("top"), F.col("total") - F.col("w"))).alias("bound")))


def top_pairs(details: DataFrame, k: int = 10, distinct_per_order: bool = False, seed_products: int = SEED_PRODUCTS,
              growth: int = GROWTH, split_above: int | None = 2048, trace: list | None = None) -> DataFrame:
    """T4 by threshold: the k greatest ``(product_a, product_b, co_count)``, equal counts by ascending ids.

    Equals the first k rows of the sorted ``co_purchase``, but counts only pairs
    of products that can still reach the list.  A pair's count is at most the
    lesser bound of its two products (``pair_bounds``).  The first round counts
    the pairs of the ``seed_products`` with the greatest bounds.  The k-th count
    found is a threshold: a product whose bound lies below it is in no pair of
    the list, one that ties with it may be.  Each further round admits the
    products with the next greatest bounds, at most ``growth`` times as many as
    before, and counts the pairs with at least one new product; it ends when
    all products at or above the threshold are in.

    Where counts are even (no product pair stands out), no bound falls below
    the threshold and the rounds add up to ``co_purchase``, each pair still
    counted once.  Only k rows and one count per round reach the driver.
    ``trace`` takes a dict per round: products, threshold.  Fewer than k pairs
    give all of them; an empty table none.
    """
    spark = details.sparkSession
    items = stored_table(_weighted_items(details, distinct_per_order), "pair-items")
    bounds = stored_table(pair_bounds(items), "pair-bounds")
    best: list = []
    schema = f"product_a {items.schema['product_id'].dataType.simpleString()}, product_b " \
             f"{items.schema['product_id'].dataType.simpleString()}, co_count bigint"
    order = [F.col("co_count").desc(), F.col("product_a").asc(), F.col("product_b").asc()]
    low, taken, wanted = None, 0, seed_products       # products with a bound of ``low`` or more are in
    while True:
        need = best[-1]["co_count"] if len(best) == k else 1
        left = bounds.where(F.col("bound") >= need)
        if low is not None:
            left = left.where(F.col("bound") < low)
        n_left = left.count()
        if not n_left:
            break
        # a bound at which about ``wanted`` products are in; all that tie with it come along
        share = max(0.0, 1 - (wanted - taken) / n_left)
        cut = left.agg(F.percentile_approx("bound", share) if share else F.min("bound")).first()[0]
        old = F.lit(False) if low is None else F.col("bound") >= low
        admitted = items.join(bounds.where(F.col("bound") >= cut).select("product_id", old.alias("old")), "product_id")
        pairs = _count_pairs(admitted, split_above, "old")
        if best:
            pairs = pairs.unionByName(spark.createDataFrame(best, schema))
        best = pairs.orderBy(*order).limit(k).collect()                     # k rows
        low, taken = cut, bounds.where(F.col("bound") >= cut).count()
        if trace is not None:
            trace.append({"products": taken, "threshold": best[-1]["co_count"] if len(best) == k else 0})
        wanted = taken * growth
    return spark.createDataFrame(best, schema)


def top_co_purchase(details: DataFrame, products: DataFrame, k: int = 10,
                    distinct_per_order: bool = False, pairs: DataFrame | None = None) -> DataFrame:
    """T4 + J5: the k most co-purchased pairs with both product names.

    The product table meets the at most 2k ids of the list in a semi join
    whose broadcast side is the ids, so products are only scanned, never
    shuffled; the names join the list by Spark's own choice.  Pass ``pairs`` (a
    ``co_purchase`` or ``top_pairs`` result) to reuse an already computed pair table.
    """
    if pairs is None:
        pairs = co_purchase(details, distinct_per_order)
    top = (pairs
           .orderBy(F.col("co_count").desc(), F.col("product_a").asc(), F.col("product_b").asc())
           .limit(k))
    ids = top.select(F.explode(F.array("product_a", "product_b")).alias("product_id")).distinct()
    names = products.select("product_id", "product_name").join(F.broadcast(ids), "product_id", "left_semi")   # 2k ids
    return (top.join(names.select(F.col("product_id").alias("product_a"), F.col("product_name").alias("name_a")),
                     "product_a", "left")
            .join(names.select(F.col("product_id").alias("product_b"), F.col("product_name").alias("name_b")),
                  "product_b", "left")
            .select("product_a", "product_b", "name_a", "name_b", "co_count"))
