"""Query registry: every operator bound to the TESTDATA tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB
text over the raw TESTDATA views) are kept side by side here; the root
``__spark_entry__`` only re-exports them.  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplake.operators import baskets, clean, ml, products, quality, rollups, trade, users
from shoplake.plans.sqltext import dbl, dwd_sql, mavg, msum, pct, rnd, with_ctes
from shoplake.session import shared_dir, stored_table
from shoplake.sources import bindings as B
from shoplake.sources import layer, snapshot
from shoplake.sources.sinks import write_result
from shoplake.streaming import io as sio
from shoplake.streaming import late, windows

# TESTDATA order dates end on 2001-08-01; recency is measured from the next day.
AS_OF = "2001-08-02"

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _dwd(spark, sf):
    return clean.dwd_order(B.fact_order(spark, sf))


DWD = dwd_sql()

# --- cleaning -----------------------------------------------------------------------------

register("valid_orders", with_ctes(
    "SELECT order_id, user_id, order_status, CAST(actual_amount AS DOUBLE) AS actual_amount "
    "FROM fact_order WHERE order_status IN ('paid','shipped','completed') AND actual_amount > 0"))(
    lambda s, d: clean.valid_orders(B.fact_order(s, d)))

register("dwd_order", with_ctes("SELECT * FROM dwd", dwd=DWD))(_dwd)

register("rejected_orders", with_ctes(
    "SELECT COUNT(*) AS total, "
    "CAST(SUM(CASE WHEN order_status IN ('paid','shipped','completed') "
    "AND actual_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept, CAST(0 AS BIGINT) AS unfit_amounts, "
    "COUNT(*) - CAST(SUM(CASE WHEN order_status IN ('paid','shipped','completed') "
    "AND actual_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rejected "
    "FROM fact_order"))(
    lambda s, d: clean.rejected_orders(B.fact_order(s, d)))

register("weekend_trade", with_ctes(
    "SELECT CAST(CASE WHEN isodow(order_date) IN (6, 7) THEN 1 ELSE 0 END AS INT) AS is_weekend, "
    f"COUNT(order_id) AS order_cnt, {msum('actual_amount')} AS total_revenue "
    "FROM dwd GROUP BY 1", dwd=DWD))(
    lambda s, d: clean.weekend_trade(_dwd(s, d)))

# --- trade --------------------------------------------------------------------------------

DAILY_TRADE = (
    f"SELECT order_date, COUNT(order_id) AS order_cnt, {msum('order_amount')} AS total_gmv, "
    f"{msum('discount_amount')} AS total_discount, {msum('actual_amount')} AS total_revenue, "
    f"{mavg('actual_amount')} AS avg_order_value, COUNT(user_id) AS buyer_cnt, "
    "COUNT(DISTINCT user_id) AS distinct_buyer_cnt FROM dwd GROUP BY order_date")

register("daily_trade", with_ctes(DAILY_TRADE, dwd=DWD))(
    lambda s, d: trade.daily_trade(_dwd(s, d)))

register("daily_payment", with_ctes(
    f"SELECT order_date, payment_method, COUNT(order_id) AS order_cnt, "
    f"{msum('actual_amount')} AS total_amount FROM dwd GROUP BY order_date, payment_method",
    dwd=DWD))(lambda s, d: trade.daily_payment(_dwd(s, d)))

register("top_gmv_days", with_ctes(
    "SELECT * FROM daily ORDER BY total_gmv DESC, order_date ASC LIMIT 5",
    dwd=DWD, daily=DAILY_TRADE))(lambda s, d: trade.top_gmv_days(_dwd(s, d), 5))

register("payment_share", with_ctes(
    "SELECT payment_method, order_cnt, "
    f"{pct('order_cnt', 'SUM(order_cnt) OVER ()')} AS pct FROM "
    "(SELECT payment_method, COUNT(order_id) AS order_cnt FROM dwd GROUP BY payment_method)",
    dwd=DWD))(lambda s, d: trade.payment_share(_dwd(s, d)))

register("kpi_dashboard", with_ctes(
    f"SELECT COUNT(order_id) AS total_orders, {msum('actual_amount')} AS total_revenue, "
    f"{mavg('actual_amount')} AS avg_order_value, COUNT(user_id) AS total_buyers, "
    "COUNT(DISTINCT user_id) AS distinct_buyers FROM dwd", dwd=DWD))(
    lambda s, d: trade.kpi_dashboard(_dwd(s, d)))

register("order_amount_stats", with_ctes(
    f"SELECT COUNT(*) AS order_cnt, {msum('actual_amount')} AS total_amount, "
    f"{mavg('actual_amount')} AS avg_amount, "
    "CAST(MAX(CAST(actual_amount AS DECIMAL(18,2))) AS DOUBLE) AS max_amount "
    "FROM fact_order WHERE order_status IN ('paid','shipped','completed')"))(
    lambda s, d: trade.order_amount_stats(B.fact_order(s, d)))

register("status_distribution", with_ctes(
    "SELECT order_status, COUNT(*) AS cnt FROM fact_order GROUP BY order_status"))(
    lambda s, d: trade.status_distribution(B.fact_order(s, d)))

# --- users --------------------------------------------------------------------------------


M_CUTS = (2000000, 1000000)  # spend cut-offs that make all three M scores occur on TESTDATA

CITY_STATS = (
    f"SELECT city, COUNT(user_id) AS user_cnt, CAST({rnd('AVG(age)', 0)} AS INT) AS avg_age, "
    f"{rnd('AVG(vip_level)', 2)} AS avg_vip FROM dim_user GROUP BY city")

register("city_stats", with_ctes(CITY_STATS))(
    lambda s, d: users.city_stats(B.dim_user(s, d)))

register("top_cities", with_ctes(
    "SELECT * FROM cs ORDER BY user_cnt DESC, city ASC LIMIT 10", cs=CITY_STATS))(
    lambda s, d: users.top_cities(B.dim_user(s, d), 10))

register("user_orders", with_ctes(
    "SELECT d.*, u.city, u.vip_level, u.register_date FROM dwd d "
    "LEFT JOIN dim_user u ON d.user_id = u.user_id", dwd=DWD))(
    lambda s, d: users.user_orders(_dwd(s, d), B.dim_user(s, d)))

register("vip_analysis", with_ctes(
    f"SELECT u.vip_level, COUNT(DISTINCT d.user_id) AS user_cnt, COUNT(d.order_id) AS order_cnt, "
    f"{msum('d.actual_amount')} AS total_revenue, {mavg('d.actual_amount')} AS avg_order_value, "
    f"{rnd(msum('d.actual_amount') + ' / COUNT(DISTINCT d.user_id)', 2)} AS arpu "
    "FROM dwd d LEFT JOIN dim_user u ON d.user_id = u.user_id GROUP BY u.vip_level", dwd=DWD))(
    lambda s, d: users.vip_analysis(_dwd(s, d), B.dim_user(s, d)))

USER_SPENDING = (
    f"SELECT user_id, COUNT(order_id) AS order_cnt, {msum('actual_amount')} AS total_spent, "
    f"{mavg('actual_amount')} AS avg_per_order, MAX(order_date) AS last_order_date "
    "FROM dwd GROUP BY user_id")

register("user_spending", with_ctes(USER_SPENDING, dwd=DWD))(
    lambda s, d: users.user_spending(_dwd(s, d)))

def rfm_fixed_sql(m_cuts) -> str:
    return (
        "SELECT *, CAST(CASE WHEN recency_days <= 7 THEN 3 WHEN recency_days <= 30 THEN 2 ELSE 1 END AS INT) AS r_score, "
        "CAST(CASE WHEN order_cnt >= 10 THEN 3 WHEN order_cnt >= 3 THEN 2 ELSE 1 END AS INT) AS f_score, "
        f"CAST(CASE WHEN total_spent >= {m_cuts[0]} THEN 3 WHEN total_spent >= {m_cuts[1]} THEN 2 ELSE 1 END AS INT) AS m_score "
        f"FROM (SELECT *, CAST(date_diff('day', last_order_date, DATE '{AS_OF}') AS INT) AS recency_days FROM us)")


RFM_FIXED = rfm_fixed_sql(M_CUTS)
RFM_FIXED_TIER = (
    "SELECT *, CASE WHEN rfm_total >= 7 THEN 'high' WHEN rfm_total >= 5 THEN 'mid' ELSE 'low' END AS user_tier "
    "FROM (SELECT *, CAST(r_score + f_score + m_score AS INT) AS rfm_total FROM rf)")
RFM_CTES = dict(dwd=DWD, us=USER_SPENDING, rf=RFM_FIXED, rfm=RFM_FIXED_TIER)


def _rfm_fixed(s, d):
    return users.rfm_fixed(_dwd(s, d), as_of=AS_OF, m=M_CUTS)


register("rfm_fixed", with_ctes("SELECT * FROM rfm", **RFM_CTES))(_rfm_fixed)

register("tier_summary", with_ctes(
    f"SELECT user_tier, COUNT(user_id) AS user_cnt, {mavg('total_spent')} AS avg_spent, "
    f"{rnd('CAST(SUM(order_cnt) AS DOUBLE) / COUNT(order_cnt)', 1)} AS avg_orders "
    "FROM rfm GROUP BY user_tier", **RFM_CTES))(
    lambda s, d: users.tier_summary(_rfm_fixed(s, d)))

register("top_high_value_users", with_ctes(
    "SELECT user_id, order_cnt, total_spent, recency_days, rfm_total FROM rfm "
    "WHERE user_tier = 'high' ORDER BY total_spent DESC, user_id ASC LIMIT 10", **RFM_CTES))(
    lambda s, d: users.top_high_value_users(_rfm_fixed(s, d), 10))

RFM_BASE = (
    f"SELECT user_id, COUNT(order_id) AS frequency, {msum('actual_amount')} AS monetary, "
    "MAX(order_date) AS last_order_date, "
    f"CAST(date_diff('day', MAX(order_date), DATE '{AS_OF}') AS INT) AS recency "
    "FROM dwd GROUP BY user_id")


# Quantiles spelled out: order statistics by ROW_NUMBER and the pandas interpolation.
RFM_LONG = (
    "SELECT 'r' AS m, CAST(recency AS DOUBLE) AS x FROM base WHERE recency IS NOT NULL "
    "UNION ALL SELECT 'f', CAST(frequency AS DOUBLE) FROM base WHERE frequency IS NOT NULL "
    "UNION ALL SELECT 'm', CAST(monetary AS DOUBLE) FROM base WHERE monetary IS NOT NULL")
RFM_RANKED = "SELECT m, x, ROW_NUMBER() OVER (PARTITION BY m ORDER BY x) - 1 AS i FROM lng"
RFM_POS = (
    "SELECT m, k, pos - FLOOR(pos) AS t, CAST(FLOOR(pos) AS BIGINT) AS f, "
    "CAST(CEIL(pos) AS BIGINT) AS c FROM (SELECT l.m, ps.k, "
    "CAST(ps.p AS DOUBLE) * CAST(COUNT(*) - 1 AS DOUBLE) AS pos FROM lng l, "
    "(VALUES ('q33', 0.33), ('q66', 0.66)) ps(k, p) GROUP BY l.m, ps.k, ps.p)")
RFM_Q = (
    "SELECT m, k, CASE WHEN t >= 0.5 THEN hi - (hi - lo) * (1 - t) ELSE lo + (hi - lo) * t END AS q "
    "FROM (SELECT s.m, s.k, s.t, MAX(CASE WHEN r.i = s.f THEN r.x END) AS lo, "
    "MAX(CASE WHEN r.i = s.c THEN r.x END) AS hi FROM pos s JOIN rk r "
    "ON r.m = s.m AND (r.i = s.f OR r.i = s.c) GROUP BY s.m, s.k, s.t)")
RFM_THRESH = "SELECT " + ", ".join(
    f"MAX(CASE WHEN m = '{m}' AND k = '{k}' THEN q END) AS {m}_{k}"
    for m in "rfm" for k in ("q33", "q66")) + " FROM qs"
RFM_TH_CTES = dict(lng=RFM_LONG, rk=RFM_RANKED, pos=RFM_POS, qs=RFM_Q, th=RFM_THRESH)
RFM_SCORED = (
    "SELECT user_id, frequency, monetary, last_order_date, recency, "
    "CAST(CASE WHEN recency <= r_q33 THEN 3 WHEN recency <= r_q66 THEN 2 ELSE 1 END AS INT) AS r_score, "
    "CAST(CASE WHEN frequency >= f_q66 THEN 3 WHEN frequency >= f_q33 THEN 2 ELSE 1 END AS INT) AS f_score, "
    "CAST(CASE WHEN monetary >= m_q66 THEN 3 WHEN monetary >= m_q33 THEN 2 ELSE 1 END AS INT) AS m_score "
    "FROM base CROSS JOIN th")
RFM_LABELLED = (
    "SELECT *, CASE "
    "WHEN r_score = 3 AND f_score >= 2 AND m_score >= 2 THEN 'key_value' "
    "WHEN r_score = 3 AND f_score <= 1 AND m_score >= 2 THEN 'key_develop' "
    "WHEN r_score <= 2 AND f_score >= 2 AND m_score >= 2 THEN 'key_retain' "
    "WHEN r_score <= 2 AND f_score <= 1 AND m_score >= 2 THEN 'key_win_back' "
    "WHEN r_score = 3 AND f_score >= 2 AND m_score <= 1 THEN 'general_value' "
    "WHEN r_score <= 2 AND f_score >= 2 AND m_score <= 1 THEN 'general_retain' "
    "WHEN r_score <= 2 AND f_score <= 1 AND m_score <= 1 THEN 'lost' "
    "ELSE 'new' END AS rfm_label FROM sc")
TERCILE_CTES = dict(dwd=DWD, base=RFM_BASE, **RFM_TH_CTES, sc=RFM_SCORED, lab=RFM_LABELLED)


def _rfm_base(s, d):
    return users.rfm_base(_dwd(s, d), as_of=AS_OF)


def _rfm_tercile(s, d):
    return users.rfm_tercile(_rfm_base(s, d))


register("rfm_base", with_ctes("SELECT * FROM base", dwd=DWD, base=RFM_BASE))(_rfm_base)
register("rfm_thresholds", with_ctes("SELECT * FROM th", dwd=DWD, base=RFM_BASE, **RFM_TH_CTES))(
    lambda s, d: users.rfm_thresholds(_rfm_base(s, d)))
register("rfm_tercile", with_ctes("SELECT * FROM lab", **TERCILE_CTES))(_rfm_tercile)
register("rfm_summary", with_ctes(
    f"SELECT rfm_label, COUNT(user_id) AS user_cnt, "
    f"{rnd('CAST(SUM(frequency) AS DOUBLE) / COUNT(frequency)', 1)} AS avg_freq, "
    f"{mavg('monetary')} AS avg_money, "
    f"{rnd('CAST(SUM(recency) AS DOUBLE) / COUNT(recency)', 0)} AS avg_recency_days "
    "FROM lab GROUP BY rfm_label", **TERCILE_CTES))(
    lambda s, d: users.rfm_summary(_rfm_tercile(s, d)))

register("repurchase_dist", with_ctes(
    f"SELECT purchase_cnt, user_cnt, {pct('user_cnt', 'SUM(user_cnt) OVER ()')} AS pct FROM ("
    "SELECT CASE WHEN frequency = 1 THEN '1' WHEN frequency = 2 THEN '2' "
    "WHEN frequency BETWEEN 3 AND 5 THEN '3-5' WHEN frequency BETWEEN 6 AND 10 THEN '6-10' "
    "ELSE '>10' END AS purchase_cnt, COUNT(user_id) AS user_cnt FROM base GROUP BY 1)",
    dwd=DWD, base=RFM_BASE))(lambda s, d: users.repurchase_dist(_rfm_base(s, d)))

FIRST_ORDER = (
    "SELECT d.user_id, strftime(u.register_date, '%Y-%m') AS register_month, "
    "MIN(d.order_date) AS first_order_date, strftime(MIN(d.order_date), '%Y-%m') AS first_order_month "
    "FROM dwd d LEFT JOIN dim_user u ON d.user_id = u.user_id GROUP BY d.user_id, 2")

register("first_order", with_ctes(FIRST_ORDER, dwd=DWD))(
    lambda s, d: users.first_order(_dwd(s, d), B.dim_user(s, d)))

register("cohort_conversion", with_ctes(
    "SELECT register_month, registered_users, first_month_buyers, "
    f"{pct('first_month_buyers', 'registered_users')} AS conversion_rate FROM ("
    "SELECT register_month, COUNT(DISTINCT user_id) AS registered_users, "
    "COUNT(DISTINCT CASE WHEN first_order_month = register_month THEN user_id END) AS first_month_buyers "
    "FROM fo GROUP BY register_month)", dwd=DWD, fo=FIRST_ORDER))(
    lambda s, d: users.cohort_conversion(_dwd(s, d), B.dim_user(s, d)))

# --- products -----------------------------------------------------------------------------


DIFF = "(CAST(price AS DECIMAL(18,2)) - CAST(cost AS DECIMAL(18,2)))"
LP = "fact_order_detail l LEFT JOIN dim_product p ON l.product_id = p.product_id"

register("detail_products", with_ctes(
    f"SELECT l.order_id, l.product_id, l.quantity, {dbl('l.subtotal')} AS subtotal, "
    f"p.category, p.brand, {dbl('p.cost')} AS cost FROM {LP}"))(
    lambda s, d: products.detail_products(B.fact_order_detail(s, d), B.dim_product(s, d)))

SUBTOTAL = "l.subtotal"
_PROFIT = ("SUM(CAST(l.subtotal AS DECIMAL(18,2)) - l.quantity * CAST(p.cost AS DECIMAL(18,2)))")
register("category_sales", with_ctes(
    f"SELECT p.category, COUNT(DISTINCT l.product_id) AS product_cnt, COUNT(l.detail_id) AS sold_qty, "
    f"CAST(SUM(l.quantity) AS BIGINT) AS units_sold, {msum('l.subtotal')} AS total_gmv, "
    f"CAST({_PROFIT} AS DOUBLE) AS total_profit, "
    f"{rnd(f'CAST({_PROFIT} AS DOUBLE) / NULLIF({msum(SUBTOTAL)}, 0) * 100', 1)} "
    f"AS profit_margin_pct FROM {LP} GROUP BY p.category"))(
    lambda s, d: products.category_sales(B.fact_order_detail(s, d), B.dim_product(s, d)))

register("category_catalog", with_ctes(
    f"SELECT category, COUNT(product_id) AS product_cnt, {mavg('price')} AS avg_price, "
    f"{mavg(DIFF)} AS avg_profit_per_item FROM dim_product GROUP BY category"))(
    lambda s, d: products.category_catalog(B.dim_product(s, d)))

BRAND_SALES = (
    f"SELECT p.category, p.brand, {msum('l.subtotal')} AS brand_sales, "
    f"COUNT(DISTINCT l.product_id) AS brand_products FROM {LP} GROUP BY p.category, p.brand")

register("brand_sales", with_ctes(BRAND_SALES))(
    lambda s, d: products.brand_sales(B.fact_order_detail(s, d), B.dim_product(s, d)))

register("brand_top3", with_ctes(
    "SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY category "
    "ORDER BY brand_sales DESC NULLS LAST, brand ASC NULLS FIRST) AS INT) AS brand_rank FROM bs) "
    "WHERE brand_rank <= 3", bs=BRAND_SALES))(
    lambda s, d: products.brand_top3(B.fact_order_detail(s, d), B.dim_product(s, d), 3))

register("brand_catalog", with_ctes(
    f"SELECT category, brand, COUNT(product_id) AS product_cnt, {mavg('price')} AS avg_price "
    "FROM dim_product GROUP BY category, brand"))(
    lambda s, d: products.brand_catalog(B.dim_product(s, d)))

register("high_profit_top20", with_ctes(
    "SELECT * FROM (SELECT product_id, product_name, category, brand, "
    f"{dbl('price')} AS price, {dbl('cost')} AS cost, CAST({DIFF} AS DOUBLE) AS profit_per_item, "
    f"{rnd(f'CAST({DIFF} AS DOUBLE) / NULLIF(CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE), 0) * 100', 1)} AS margin, "
    f"CAST(ROW_NUMBER() OVER (ORDER BY {DIFF} DESC NULLS LAST, product_id ASC NULLS FIRST) AS INT) AS profit_rank "
    "FROM dim_product) WHERE profit_rank <= 20"))(
    lambda s, d: products.high_profit_top(B.dim_product(s, d), 20))

register("price_distribution", with_ctes(
    "SELECT category, COUNT(product_id) AS product_cnt, "
    "CAST(MIN(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS min_price, "
    f"{mavg('price')} AS avg_price, CAST(MAX(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS max_price, "
    f"{mavg(DIFF)} AS avg_margin FROM dim_product GROUP BY category"))(
    lambda s, d: products.price_distribution(B.dim_product(s, d)))

# --- baskets ------------------------------------------------------------------------------

BASKETS = ("SELECT order_id, CAST(COUNT(product_id) AS INT) AS basket_size FROM fact_order_detail "
           "GROUP BY order_id HAVING COUNT(product_id) >= 2")
register("baskets", with_ctes(BASKETS))(
    lambda s, d: baskets.baskets(B.fact_order_detail(s, d), 2))
register("multi_product_orders", with_ctes("SELECT COUNT(*) AS order_cnt FROM bk", bk=BASKETS))(
    lambda s, d: baskets.multi_product_orders(B.fact_order_detail(s, d), 2))

CO_PURCHASE = (
    "SELECT a.product_id AS product_a, b.product_id AS product_b, COUNT(*) AS co_count "
    "FROM fact_order_detail a JOIN fact_order_detail b "
    "ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2")
register("co_purchase", with_ctes(CO_PURCHASE))(
    lambda s, d: baskets.co_purchase(B.fact_order_detail(s, d)))
register("top_co_purchase", with_ctes(
    "SELECT t.product_a, t.product_b, pa.product_name AS name_a, pb.product_name AS name_b, t.co_count "
    "FROM (SELECT * FROM co ORDER BY co_count DESC, product_a, product_b LIMIT 10) t "
    "LEFT JOIN dim_product pa ON t.product_a = pa.product_id "
    "LEFT JOIN dim_product pb ON t.product_b = pb.product_id", co=CO_PURCHASE))(
    lambda s, d: baskets.top_co_purchase(B.fact_order_detail(s, d), B.dim_product(s, d), 10))
register("top_pairs", ORACLE_SQL["top_co_purchase"])(
    lambda s, d: baskets.top_co_purchase(B.fact_order_detail(s, d), B.dim_product(s, d), 10,
                                         pairs=baskets.top_pairs(B.fact_order_detail(s, d), 10)))

# --- ML -----------------------------------------------------------------------------------


RATINGS = (
    "SELECT o.user_id, l.product_id, COUNT(l.detail_id) AS purchase_count, "
    "CAST(COUNT(l.detail_id) AS DOUBLE) AS rating "
    "FROM fact_order_detail l JOIN fact_order o ON l.order_id = o.order_id "
    "WHERE o.order_status IN ('paid','shipped','completed') AND o.user_id IS NOT NULL "
    "GROUP BY o.user_id, l.product_id")


def _ratings(s, d):
    return ml.ratings(B.fact_order_detail(s, d), B.fact_order(s, d))


def _top_k_contract(s, d, data):
    return ml.top_k_contract(ml.als_top_k(None, B.dim_product(s, d), 5, data=data), data.ratings)


register("ratings", with_ctes(RATINGS))(_ratings)
register("rating_stats", with_ctes(
    "SELECT COUNT(*) AS pairs, COUNT(DISTINCT user_id) AS users, "
    "COUNT(DISTINCT product_id) AS products FROM r", r=RATINGS))(
    lambda s, d: ml.rating_stats(_ratings(s, d)))
register("user_features", with_ctes(
    f"SELECT user_id, COUNT(order_id) AS order_cnt, {msum('actual_amount')} AS total_spent, "
    f"{mavg('actual_amount')} AS avg_order_value FROM dwd GROUP BY user_id", dwd=DWD))(
    lambda s, d: ml.user_features(_dwd(s, d)))

# rows-only checks: fitted models have no SQL twin
register("als_rmse")(lambda s, d: ml.als_rmse(s, _ratings(s, d)))
register("als_top5")(lambda s, d: ml.als_top_k(_ratings(s, d), B.dim_product(s, d), 5))
register("user_clusters")(lambda s, d: ml.user_clusters(_dwd(s, d)))
register("cluster_summary")(lambda s, d: ml.cluster_summary(ml.user_clusters(_dwd(s, d))))
register("cluster_quality")(lambda s, d: ml.cluster_quality(_dwd(s, d)))

# what any fit must meet, and the parts around the fits, in SQL
IS_TRAIN = ("CAST('0x' || substr(md5('42:' || CAST(user_id AS VARCHAR) || ':' || CAST(product_id AS VARCHAR)), 1, 8) "
            "AS BIGINT) % 100 < 80")
register("als_split", with_ctes(f"SELECT user_id, product_id, {IS_TRAIN} AS is_train FROM r", r=RATINGS))(
    lambda s, d: ml.split_ratings(_ratings(s, d)))
register("als_top5_contract", with_ctes(
    f"SELECT COUNT(DISTINCT user_id) AS users, CAST(5 AS BIGINT) AS min_rows, CAST(5 AS BIGINT) AS max_rows, "
    f"CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS unknown_products FROM r WHERE {IS_TRAIN}", r=RATINGS))(
    lambda s, d: _top_k_contract(s, d, ml.rating_data(_ratings(s, d))))
_SCALED = ", ".join(rnd(f"({c} - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER ()", 4) + f" AS {c}_scaled"
                    for c in ("order_cnt", "total_spent", "avg_order_value"))
register("scaled_features", with_ctes(
    f"SELECT user_id, {_SCALED} FROM (SELECT user_id, COUNT(order_id) AS order_cnt, {msum('actual_amount')} AS total_spent, "
    f"{mavg('actual_amount')} AS avg_order_value FROM dwd GROUP BY user_id)", dwd=DWD))(
    lambda s, d: ml.scaled_features(ml.user_features(_dwd(s, d))))
register("cluster_contract", with_ctes(
    "SELECT CAST(4 AS BIGINT) AS clusters, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT user_id) AS user_rows FROM dwd",
    dwd=DWD))(
    lambda s, d: ml.user_clusters(_dwd(s, d)).agg(
        F.count_distinct("cluster").alias("clusters"), F.count_distinct("user_id").alias("users"),
        F.count("user_id").alias("user_rows")))
register("als_checked", with_ctes(
    f"SELECT COUNT(*) FILTER (WHERE {IS_TRAIN}) AS train_rows, COUNT(*) FILTER (WHERE NOT ({IS_TRAIN})) AS test_rows, "
    "TRUE AS stationary, TRUE AS rmse_agrees, TRUE AS scores_agree FROM r", r=RATINGS))(
    lambda s, d: ml.als_checked(_ratings(s, d)))
register("cluster_checked", with_ctes(
    "SELECT COUNT(DISTINCT user_id) AS users, CAST(4 AS INT) AS clusters, TRUE AS nearest, TRUE AS silhouette_agrees FROM dwd",
    dwd=DWD))(lambda s, d: ml.cluster_checked(_dwd(s, d)))
register("recommendation_sample", with_ctes(
    "SELECT * FROM r WHERE user_id IN (SELECT DISTINCT user_id FROM r ORDER BY user_id LIMIT 3)", r=RATINGS))(
    lambda s, d: ml.sample_recommendations(_ratings(s, d), 3))

# --- quality and lake ---------------------------------------------------------------------

register("table_row_counts", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for t in sorted(B.BINDING_SQL))))(
    lambda s, d: quality.table_row_counts(B.business_tables(s, d)))


register("snapshot_project", with_ctes(
    "SELECT order_id, user_id, order_status, CAST(order_amount AS DOUBLE) AS order_amount, "
    "CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(actual_amount AS DOUBLE) AS actual_amount, "
    "payment_method, strftime(order_time, '%Y-%m-%d %H:%M:%S') AS order_time FROM fact_order"))(
    lambda s, d: snapshot.snapshot_project(B.fact_order(s, d)))



def _snapshot_roundtrip(s, d):
    orders = B.fact_order(s, d)
    root = shared_dir(s, "snapshot")
    snapshot.write_snapshot(orders, root, "fact_order", AS_OF)
    return snapshot.read_snapshot(s, root, "fact_order", AS_OF, snapshot.snapshot_project(orders).schema)


def _result_roundtrip(s, d):
    daily = trade.daily_trade(_dwd(s, d))
    path = write_result(daily, shared_dir(s, "result"))
    return s.read.schema(daily.schema).options(header="true", sep="\t").csv(path)


def _weekend_days(s, d):
    dwd = _dwd(s, d)
    path = shared_dir(s, "order-layer")
    layer.write_order_layer(dwd, path)
    days = stored_table(layer.calendar(dwd), "calendar").where("is_weekend = 1")
    return layer.day_totals(layer.read_order_layer(s, path, dwd.schema), days, B.fact_order_detail(s, d))


register("weekend_days", with_ctes(
    f"SELECT order_date, COUNT(order_id) AS order_cnt, {msum('actual_amount')} AS total_revenue, "
    "CAST(SUM((SELECT COUNT(*) FROM fact_order_detail l WHERE l.order_id = dwd.order_id)) AS BIGINT) AS line_cnt "
    "FROM dwd WHERE dayofweek(order_date) IN (0, 6) GROUP BY order_date", dwd=DWD))(_weekend_days)


def _snapshot_checked(s, d):
    """The orders as tab-separated lines, some cut short or with text in a number field, read back."""
    orders = snapshot.snapshot_project(B.fact_order(s, d))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in orders.columns]
    first = F.when(F.col("order_id") % 101 == 0, F.concat(F.lit("no."), cells[0])).otherwise(cells[0])
    line = F.when(F.col("order_id") % 97 == 0, F.concat_ws("\t", *cells[:3])).otherwise(F.concat_ws("\t", first, *cells[1:]))
    root = shared_dir(s, "snapshot-lines")
    orders.select(line.alias("value")).write.text(snapshot.snapshot_path(root, "fact_order", AS_OF))
    good, bad = snapshot.read_snapshot_checked(s, root, "fact_order", AS_OF, orders.schema)
    return good.groupBy("order_status").agg(F.count(F.lit(1)).alias("row_count"), F.sum("order_id").alias("id_sum")).unionByName(
        bad.agg(F.lit("~corrupt").alias("order_status"), F.count("line").alias("row_count"), F.lit(None).cast("long").alias("id_sum")))


register("snapshot_checked", with_ctes(
    "SELECT CASE WHEN order_id % 97 = 0 OR order_id % 101 = 0 THEN '~corrupt' ELSE order_status END AS order_status, "
    "COUNT(*) AS row_count, CAST(SUM(CASE WHEN order_id % 97 = 0 OR order_id % 101 = 0 THEN NULL ELSE order_id END) AS BIGINT) AS id_sum "
    "FROM fact_order GROUP BY 1"))(_snapshot_checked)


def _catalog_scan(s, d):
    lake = B.fact_order(s, d)
    root = shared_dir(s, "catalog")
    path = snapshot.write_snapshot(lake, root, "fact_order", AS_OF, fmt="parquet")
    snapshot.create_database(s, "shoplake_check")
    name = snapshot.register_snapshot(s, "shoplake_check", "fact_order", path,
                                      snapshot.snapshot_project(lake).schema, fmt="parquet")
    return snapshot.read_catalog_table(s, name, ["order_id", "user_id", "actual_amount", "order_status"],
                                       "order_status = 'paid'")


ITEM_COLS = ("product_id", "quantity", "subtotal")


def _nested_orders(s, d):
    return windows.nested_orders(B.fact_order(s, d).select("order_id", "order_time"), B.fact_order_detail(s, d), ITEM_COLS)


def _order_items(s, d):
    nested = _nested_orders(s, d).select("order_id", "items")
    return windows.explode_order_items(nested).withColumn("subtotal", F.col("subtotal").cast("double"))


def _order_item_totals_stream(s, d):
    path = shared_dir(s, "nested-orders")
    _nested_orders(s, d).write.parquet(path)
    return sio.stream_item_totals(s, path, {"order_time": sio.SENTINEL_TIME})


def _order_feed(s, d):
    """Valid orders that carry a product_id of their own, as the fallback's input would."""
    first = B.fact_order_detail(s, d).groupBy("order_id").agg(F.min("product_id").alias("product_id"))
    return clean.valid_orders(B.fact_order(s, d)).join(first, "order_id")


register("snapshot_roundtrip", ORACLE_SQL["snapshot_project"])(_snapshot_roundtrip)
register("result_roundtrip", ORACLE_SQL["daily_trade"])(_result_roundtrip)
register("catalog_scan", with_ctes(
    "SELECT order_id, user_id, CAST(actual_amount AS DOUBLE) AS actual_amount, order_status FROM fact_order "
    "WHERE order_status = 'paid'"))(_catalog_scan)
register("order_items", with_ctes(
    "SELECT order_id, product_id, quantity, CAST(subtotal AS DOUBLE) AS subtotal FROM fact_order_detail"))(_order_items)
ITEM_TOTALS = (
    "SELECT date_trunc('minute', o.order_time) AS window_start, l.product_id, COUNT(*) AS line_count, "
    f"CAST(SUM(l.quantity) AS BIGINT) AS quantity, {msum('l.subtotal')} AS amount "
    "FROM fact_order_detail l JOIN fact_order o ON l.order_id = o.order_id GROUP BY 1, 2")
register("order_item_totals", with_ctes(ITEM_TOTALS))(
    lambda s, d: windows.item_window_totals(_nested_orders(s, d)))
register("order_item_totals_stream", with_ctes(ITEM_TOTALS))(_order_item_totals_stream)

# states that roll up: day sketches to months, minute bitmaps to days
_MEASURES = {"actual": "actual_amount", "discount": "discount_amount"}
_PROBS = (0.25, 0.5, 0.9)


def _monthly_quantiles(s, d):
    facts = _dwd(s, d).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    days = stored_table(rollups.quantile_sketches(facts, ["month", "order_date"], _MEASURES), "day-sketches")
    months = rollups.sketch_quantiles(rollups.merged_sketches(days, ["month"], list(_MEASURES)), ["month"], list(_MEASURES), _PROBS)
    return rollups.quantile_errors(facts, ["month"], _MEASURES, months, _PROBS).select(
        "month", "measure", "p", "n", (F.col("rank_error") <= 2 * rollups.rank_error() + 1 / F.col("n")).alias("within"))


register("monthly_quantiles", with_ctes(" UNION ALL ".join(
    f"SELECT strftime(order_date, '%Y-%m') AS month, '{m}' AS measure, CAST({p} AS DOUBLE) AS p, COUNT({c}) AS n, TRUE AS within "
    "FROM dwd GROUP BY 1" for m, c in _MEASURES.items() for p in _PROBS), dwd=DWD))(_monthly_quantiles)


def _daily_uv(s, d):
    events = B.user_behavior(s, d).select("user_id", "behavior_type", "behavior_time")
    ids = stored_table(ml.dense_ids(events, "user_id"), "user-ids")
    minutes = events.join(ids, "user_id").withColumn("minute", F.date_trunc("minute", "behavior_time"))
    bitmaps = stored_table(rollups.distinct_bitmaps(minutes, ["minute", "behavior_type"], "user_id_idx"), "minute-bitmaps")
    days = bitmaps.withColumn("day", F.to_date("minute"))
    return rollups.bitmap_counts(rollups.merged_bitmaps(days, ["day", "behavior_type"]), ["day", "behavior_type"])


register("daily_uv", with_ctes(
    "SELECT CAST(behavior_time AS DATE) AS day, behavior_type, COUNT(DISTINCT user_id) AS uv FROM ods_user_behavior GROUP BY 1, 2"))(_daily_uv)

# late rows as an output: the events in six steps by time, one event in ten two steps late
_STEPS = 6
_STEP = ("least({n} - 1, CAST(floor((epoch({t}) - (SELECT min(epoch({t})) FROM {f})) * {n} / (1 + (SELECT max(epoch({t})) - min(epoch({t})) "
         "FROM {f}))) AS INT) + CASE WHEN log_id % 10 = 0 THEN 2 ELSE 0 END)")
LATE_SPLIT = (
    "SELECT batch, COUNT(*) FILTER (WHERE NOT late) AS rows_kept, COUNT(*) FILTER (WHERE late) AS rows_late FROM ("
    "SELECT s.batch, date_trunc('minute', s.behavior_time) + INTERVAL 1 MINUTE <= m.newest - INTERVAL 5 SECOND AND m.newest IS NOT NULL AS late "
    "FROM steps s LEFT JOIN (SELECT b.batch, (SELECT max(t.behavior_time) FROM steps t WHERE t.batch < b.batch - 1) AS newest "
    "FROM (SELECT DISTINCT batch FROM steps) b) m ON s.batch = m.batch) GROUP BY batch")


def _late_split(s, d):
    events = B.user_behavior(s, d).select("log_id", "user_id", "behavior_type", "behavior_time")
    sec = F.unix_micros(windows.event_time(events, "behavior_time")) / 1e6
    first, last = events.agg(F.min(sec), F.max(sec)).first()
    step = F.least(F.lit(_STEPS - 1), F.floor((sec - (first or 0)) * _STEPS / (1 + ((last or 0) - (first or 0)))).cast("int")
                   + F.when(F.col("log_id") % 10 == 0, 2).otherwise(0))
    split = late.split_arrivals(events.withColumn("step", step), "step", "behavior_time", _STEPS)
    return split.groupBy("batch").agg(F.count_if(~F.col("late")).alias("rows_kept"), F.count_if("late").alias("rows_late"))


register("late_split", with_ctes(
    LATE_SPLIT, steps="SELECT *, " + _STEP.format(n=_STEPS, t="behavior_time", f="ods_user_behavior") + " AS batch FROM ods_user_behavior"))(_late_split)
register("row_gate", with_ctes(
    "SELECT 'dim_user' AS table_name, CAST(100 AS BIGINT) AS min_rows, COUNT(*) AS row_count, COUNT(*) >= 100 AS passed "
    "FROM dim_user UNION ALL SELECT 'fact_order', 1000000000, COUNT(*), COUNT(*) >= 1000000000 FROM fact_order"))(
    lambda s, d: quality.row_gate(quality.table_row_counts(
        {"dim_user": B.dim_user(s, d), "fact_order": B.fact_order(s, d)}),
        {"dim_user": 100, "fact_order": 1_000_000_000}))
register("sorted_buckets", with_ctes(
    "SELECT purchase_cnt, user_cnt, CAST(ROW_NUMBER() OVER (ORDER BY CASE purchase_cnt WHEN '1' THEN 1 WHEN '2' THEN 2 "
    "WHEN '3-5' THEN 3 WHEN '6-10' THEN 4 ELSE 5 END) AS INT) AS position FROM (SELECT CASE WHEN frequency = 1 THEN '1' "
    "WHEN frequency = 2 THEN '2' WHEN frequency BETWEEN 3 AND 5 THEN '3-5' WHEN frequency BETWEEN 6 AND 10 THEN '6-10' "
    "ELSE '>10' END AS purchase_cnt, COUNT(user_id) AS user_cnt FROM base GROUP BY 1)", dwd=DWD, base=RFM_BASE))(
    lambda s, d: users.repurchase_dist(_rfm_base(s, d)).select(
        "purchase_cnt", "user_cnt", F.row_number().over(Window.orderBy(users.bucket_order())).alias("position")))
register("category_order_sales", with_ctes(
    f"SELECT p.category, COUNT(DISTINCT o.product_id) AS product_cnt, COUNT(o.order_id) AS order_cnt, "
    f"{msum('o.actual_amount')} AS total_gmv FROM (SELECT v.order_id, v.actual_amount, f.product_id FROM (SELECT * FROM "
    "fact_order WHERE order_status IN ('paid','shipped','completed') AND actual_amount > 0) v JOIN (SELECT order_id, "
    "MIN(product_id) AS product_id FROM fact_order_detail GROUP BY order_id) f ON v.order_id = f.order_id) o "
    "LEFT JOIN dim_product p ON o.product_id = p.product_id GROUP BY p.category"))(
    lambda s, d: products.category_order_sales(_order_feed(s, d), B.dim_product(s, d)))

# --- streaming ----------------------------------------------------------------------------


UV_PV = ("SELECT date_trunc('minute', behavior_time) AS window_start, behavior_type, "
         "COUNT(DISTINCT user_id) AS uv, COUNT(*) AS pv FROM ods_user_behavior GROUP BY 1, 2")

register("behavior_uv_pv", with_ctes(UV_PV))(
    lambda s, d: windows.behavior_uv_pv(B.user_behavior(s, d)))
register("order_window_totals", with_ctes(
    "SELECT date_trunc('minute', order_time) AS window_start, "
    "date_trunc('minute', order_time) + INTERVAL 1 MINUTE AS window_end, COUNT(*) AS order_count, "
    f"{msum('actual_amount')} AS total_amount, "
    f"{msum('actual_amount')} / COUNT(actual_amount) AS avg_amount FROM fact_order GROUP BY 1, 2"))(
    lambda s, d: windows.order_window_totals(B.fact_order(s, d)))
register("json_decode", with_ctes("SELECT log_id, product_id FROM ods_user_behavior"))(
    lambda s, d: sio.json_field(B.read_table(s, d, "events").select(
        F.col("event_id").alias("log_id"), "props"), "props", "k bigint", "k")
    .select("log_id", F.col("k").alias("product_id")))
register("behavior_uv_pv_stream", with_ctes(UV_PV))(
    lambda s, d: sio.stream_uv_pv(s, B.table_path(d, "events"), B.bind_events,
                                  {"ts": sio.SENTINEL_TIME, "event_type": "~sentinel"}))
register("order_window_totals_stream", ORACLE_SQL["order_window_totals"])(
    lambda s, d: sio.stream_order_totals(s, B.table_path(d, "orders"), B.bind_orders,
                                         {"o_orderdate": sio.SENTINEL_TIME}))

register("cohort_conversion_all_users", with_ctes(
    "SELECT r.register_month, r.registered_users, COALESCE(b.fmb, 0) AS first_month_buyers, "
    f"{pct('COALESCE(b.fmb, 0)', 'r.registered_users')} AS conversion_rate FROM ("
    "SELECT strftime(register_date, '%Y-%m') AS register_month, COUNT(user_id) AS registered_users "
    "FROM dim_user GROUP BY 1) r LEFT JOIN ("
    "SELECT register_month, COUNT(DISTINCT CASE WHEN first_order_month = register_month "
    "THEN user_id END) AS fmb FROM fo GROUP BY register_month) b "
    "ON r.register_month = b.register_month", dwd=DWD, fo=FIRST_ORDER))(
    lambda s, d: users.cohort_conversion(_dwd(s, d), B.dim_user(s, d), "all_users"))

VALID_LINES = (
    "SELECT * FROM fact_order_detail WHERE order_id IN (SELECT order_id FROM fact_order "
    "WHERE order_status IN ('paid','shipped','completed') AND actual_amount > 0)")
LP_VALID = "vl l LEFT JOIN dim_product p ON l.product_id = p.product_id"

register("category_sales_valid_orders", with_ctes(
    f"SELECT p.category, COUNT(DISTINCT l.product_id) AS product_cnt, COUNT(l.detail_id) AS sold_qty, "
    f"CAST(SUM(l.quantity) AS BIGINT) AS units_sold, {msum('l.subtotal')} AS total_gmv, "
    f"CAST({_PROFIT} AS DOUBLE) AS total_profit, "
    f"{rnd(f'CAST({_PROFIT} AS DOUBLE) / NULLIF({msum(SUBTOTAL)}, 0) * 100', 1)} "
    f"AS profit_margin_pct FROM {LP_VALID} GROUP BY p.category", vl=VALID_LINES))(
    lambda s, d: products.category_sales(B.fact_order_detail(s, d), B.dim_product(s, d),
                                         orders=clean.valid_orders(B.fact_order(s, d))))

register("co_purchase_distinct", with_ctes(
    "SELECT a.product_id AS product_a, b.product_id AS product_b, "
    "COUNT(DISTINCT a.order_id) AS co_count FROM fact_order_detail a JOIN fact_order_detail b "
    "ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2"))(
    lambda s, d: baskets.co_purchase(B.fact_order_detail(s, d), distinct_per_order=True))

# the reference's own spend cut-offs (50000 / 10000): most TESTDATA users score M = 3
register("rfm_fixed_reference_cuts", with_ctes(
    "SELECT * FROM rfm", dwd=DWD, us=USER_SPENDING, rf=rfm_fixed_sql((50000, 10000)),
    rfm=RFM_FIXED_TIER))(
    lambda s, d: users.rfm_fixed(_dwd(s, d), as_of=AS_OF))
