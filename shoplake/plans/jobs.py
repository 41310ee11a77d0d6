"""The four batch jobs (etl, user, product, ml) and ``all``.

``run_job(spark, name, tables, out)`` composes the operators over a dict of
business tables and writes every result (K2) under ``out``; with
``out=None`` it shows the first rows of each instead (K5) and says so.  This
is the only module, besides the ML fits and streaming runs, that triggers
actions.  Tables may lack ``fact_order_detail`` (S9): the product job then falls back to
orders that carry a product_id, or else to the product catalog, and the ml job
leaves out recommendations.  The cleaned order layer is persisted only for
the jobs in which several results read it (K6); raw scans are never cached.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.operators import baskets, clean, ml, products, quality, trade, users
from shoplake.operators.ml import persisted
from shoplake.sources.sinks import show, write_result

Tables = Mapping[str, DataFrame]
# results with a bounded number of rows (a limit, one row, or fixed labels) go to one output file
SMALL = {"top_gmv_days", "top_cities", "top_co_purchase", "top_high_value_users", "top_margin_products",
         "kpi_dashboard", "rejected_orders", "tier_summary", "rfm_summary", "repurchase_dist", "rating_stats",
         "multi_product_orders", "als_metrics", "cluster_summary", "cluster_quality"}


def _emit(results: dict[str, DataFrame], out: str | None) -> dict[str, str]:
    written = {}
    for name, df in results.items():
        if out is None:
            print(f"--- {name} (first rows only)")
            show(df)
        else:
            written[name] = write_result(df, f"{out.rstrip('/')}/{name}", single_file=name in SMALL)
    return written


Results = tuple[dict[str, DataFrame], list[DataFrame]]


def etl_results(t: Tables, dwd: DataFrame, as_of=None) -> Results:
    facts = users.user_order_facts(dwd)
    rfm = users.rfm_fixed(None, as_of=as_of, facts=facts)
    return {
        "rejected_orders": clean.rejected_orders(t["fact_order"]),
        "daily_trade": trade.daily_trade(dwd).orderBy("order_date"),
        "user_rfm": rfm,
        "payment_dist": trade.daily_payment(dwd).orderBy("order_date", "payment_method"),
        "top_gmv_days": trade.top_gmv_days(dwd),
        "payment_share": trade.payment_share(dwd).orderBy(F.col("order_cnt").desc()),
        "tier_summary": users.tier_summary(rfm).orderBy(F.col("user_cnt").desc()),
        "top_high_value_users": users.top_high_value_users(rfm),
        "kpi_dashboard": trade.kpi_dashboard(dwd),
    }, [facts, rfm]


def user_results(t: Tables, dwd: DataFrame, as_of=None) -> Results:
    facts = users.user_order_facts(dwd)  # one per-user aggregation for every per-user result
    base = users.rfm_base(None, as_of=as_of, facts=facts)
    scored = users.rfm_tercile(base)
    return {
        "city_distribution": users.city_stats(t["dim_user"]).orderBy(F.col("user_cnt").desc()),
        "top_cities": users.top_cities(t["dim_user"]),
        "vip_analysis": users.vip_analysis(None, t["dim_user"], facts=facts).orderBy("vip_level"),
        "rfm_segmentation": scored,
        "rfm_summary": users.rfm_summary(scored).orderBy(F.col("user_cnt").desc()),
        "repurchase_dist": users.repurchase_dist(base).orderBy(users.bucket_order()),
        "cohort_conversion": users.cohort_conversion(None, t["dim_user"], facts=facts)
        .orderBy("register_month"),
    }, [facts, scored]


def _catalog_fallback(t: Tables) -> dict[str, DataFrame]:
    """A16 / A17 / A19 + J8: category and brand views without order lines."""
    p, orders = t["dim_product"], t["fact_order"]
    if "product_id" in orders.columns:
        valid = orders.where(clean.valid_predicate(orders))
        category = products.category_order_sales(valid, p).orderBy(F.col("total_gmv").desc())
    else:
        category = products.category_catalog(p).orderBy(F.col("product_cnt").desc())
    return {"category_ranking": category,
            "brand_top3": products.brand_catalog(p).orderBy("category", F.col("product_cnt").desc())}


def product_results(t: Tables, dwd: DataFrame, as_of=None) -> Results:
    p = t["dim_product"]
    views = {
        "top_margin_products": products.high_profit_top(p).orderBy("profit_rank"),
        "price_distribution": products.price_distribution(p).orderBy(F.col("product_cnt").desc()),
    }
    d = t.get("fact_order_detail")
    if d is None:
        return {**_catalog_fallback(t), **views}, []
    pairs = baskets.co_purchase(d)
    sales = products.sales_with_dims(d, p)  # one per-product aggregation of the lines
    return {
        "category_ranking": products.category_sales(None, None, sales=sales)
        .orderBy(F.col("total_gmv").desc()),
        "brand_top3": products.brand_top3(None, None, sales=sales).orderBy("category", "brand_rank"),
        "multi_product_orders": baskets.multi_product_orders(d),
        "co_occurrence": pairs.orderBy(F.col("co_count").desc(), "product_a", "product_b"),
        "top_co_purchase": baskets.top_co_purchase(d, p, pairs=pairs).orderBy(  # D12: re-sort
            F.col("co_count").desc(), "product_a", "product_b"),
        **views,
    }, [pairs, sales]


def ml_results(t: Tables, dwd: DataFrame, as_of=None) -> Results:
    spark = dwd.sparkSession
    clusters = ml.cluster_results(dwd)
    out = {**clusters, "cluster_summary": clusters["cluster_summary"].orderBy("cluster")}
    if t.get("fact_order_detail") is None:
        return out, [clusters["user_clusters"]]
    r = ml.ratings(t["fact_order_detail"], t["fact_order"])
    model, n_train, n_test, rmse = ml.als_fit_evaluate(r)
    return {
        "rating_stats": ml.rating_stats(r),
        "als_metrics": spark.createDataFrame([(n_train, n_test, float(rmse))],
                                             "train_rows bigint, test_rows bigint, rmse double"),
        "user_top5_recs": ml.als_top_k(r, t["dim_product"], model=model),
        **out,
    }, [clusters["user_clusters"]]


# each job returns its results and the intermediate frames several results read
JOBS: dict[str, Callable[[Tables, DataFrame, object], Results]] = {
    "etl": etl_results, "user": user_results, "product": product_results, "ml": ml_results,
}


def enforce_gate(gate: DataFrame) -> None:
    """Raise before a job starts if any table is below its minimum (an action)."""
    failed = gate.where(~F.col("passed")).collect()      # one row per checked table
    if failed:
        raise RuntimeError("row gate failed: " + ", ".join(
            f"{r.table_name} has {r.row_count} < {r.min_rows}" for r in failed))


def run_job(spark: SparkSession, name: str, tables: Tables, out: str | None = None,
            as_of=None, min_users: int = 100) -> dict[str, str]:
    """Run one job (or ``all``) over ``tables``; returns result name -> path."""
    gate = quality.row_gate(quality.table_row_counts({"dim_user": tables["dim_user"]}),
                            {"dim_user": min_users})
    enforce_gate(gate)
    names = list(JOBS) if name == "all" else [name]
    dwd = clean.dwd_order(tables["fact_order"])
    written: dict[str, str] = {}
    # the product job reads no cleaned orders
    with persisted(*([dwd] if set(names) - {"product"} else [])):
        for job in names:
            results, reused = JOBS[job](tables, dwd, as_of)
            with persisted(*reused):
                written.update(_emit(results, out))
    return written
