"""Hand-written edge cases (FIXTURES.md section 2) on lake-typed frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from shoplake.operators import baskets, clean, products, quality, trade, users
from shoplake.schemas import DIM_PRODUCT, DIM_USER, FACT_ORDER_DETAIL

ORDER_TEXT = StructType([
    StructField("order_id", LongType()), StructField("user_id", LongType()),
    StructField("order_status", StringType()), StructField("order_amount", StringType()),
    StructField("discount_amount", StringType()), StructField("actual_amount", StringType()),
    StructField("payment_method", StringType()), StructField("order_time", StringType())])


def orders(spark, rows):
    full = [(i, u, s, a, "0", a, p, t) for i, u, s, a, p, t in rows]
    return spark.createDataFrame(full, ORDER_TEXT)


def test_valid_filter_edges(spark):
    o = orders(spark, [
        (1, 1, "paid", "10.00", "card", "2026-05-02 10:00:00"),
        (2, 1, "cancelled", "10.00", "card", "2026-05-02 10:00:00"),
        (3, 1, "pending", "10.00", "card", "2026-05-02 10:00:00"),
        (4, 1, None, "10.00", "card", "2026-05-02 10:00:00"),
        (5, 1, "shipped", "0", "card", "2026-05-02 10:00:00"),
        (6, 1, "shipped", "-3.5", "card", "2026-05-02 10:00:00"),
        (7, 1, "completed", None, "card", "2026-05-02 10:00:00"),
        (8, 1, "completed", "abc", "card", "2026-05-02 10:00:00"),
        (9, 1, "completed", "5.5", "card", "not a date"),
    ])
    kept = sorted(r.order_id for r in clean.valid_orders(o).collect())
    assert kept == [1, 9]
    dwd = {r.order_id: r for r in clean.dwd_order(o).collect()}
    assert dwd[9].order_date is None and dwd[1].order_date == dt.date(2026, 5, 2)
    rej = clean.rejected_orders(o).first()
    assert (rej.total, rej.kept, rej.rejected) == (9, 2, 7)


def test_valid_orders_judge_the_raw_amount(spark):
    rows = [(1, 1, "paid", 0.004, 0.0, 0.004, "a", "2026-05-02 10:00:00"),
            (2, 1, "paid", 2e16, 0.0, 2e16, "a", "2026-05-02 10:00:00"),
            (3, 1, "paid", 5.0, 0.0, 5.0, "a", "2026-05-02 10:00:00"),
            (4, 1, "paid", 3e27, 0.0, 3e27, "a", "2026-05-02 10:00:00")]
    o = spark.createDataFrame(rows, "order_id long, user_id long, order_status string, order_amount double, "
                                    "discount_amount double, actual_amount double, payment_method string, order_time string")
    assert {r.order_id: r.actual_amount for r in clean.valid_orders(o).collect()} == {1: 0.004, 2: 2e16, 3: 5.0, 4: 3e27}
    rej = clean.rejected_orders(o).first()
    assert (rej.total, rej.kept, rej.rejected, rej.unfit_amounts) == (4, 4, 0, 1)
    assert trade.kpi_dashboard(clean.dwd_order(o.where("order_id < 4"))).first().total_revenue == 2e16 + 5.0


def test_distinct_counts_survive_repeated_dimension_keys(spark):
    import duckdb
    from conftest import SF_SMALL
    from shoplake.plans import registry
    from shoplake.sources import bindings as B
    con = duckdb.connect()
    for t in ("nation", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for t in ("customer", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet') UNION ALL "
                    f"SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    u, p = (f(spark, SF_SMALL).unionAll(f(spark, SF_SMALL)) for f in (B.dim_user, B.dim_product))
    dwd, d = clean.dwd_order(B.fact_order(spark, SF_SMALL)), B.fact_order_detail(spark, SF_SMALL)
    got = {"vip_analysis": users.vip_analysis(dwd, u), "first_order": users.first_order(dwd, u),
           "cohort_conversion": users.cohort_conversion(dwd, u), "category_sales": products.category_sales(d, p),
           "brand_sales": products.brand_sales(d, p)}
    for name, df in got.items():
        cur = con.execute(registry.ORACLE_SQL[name])
        cols = [c[0] for c in cur.description]
        assert sorted(map(repr, cur.fetchall())) == sorted(repr(tuple(r)) for r in df.select(cols).collect()), name


def test_weekend_flag(spark):
    # 2026-05-02 Saturday, 05-03 Sunday, 05-04 Monday
    o = orders(spark, [(1, 1, "paid", "1", "a", "2026-05-02 00:00:00"),
                       (2, 1, "paid", "2", "a", "2026-05-03 00:00:00"),
                       (3, 1, "paid", "4", "a", "2026-05-04 00:00:00")])
    got = {r.is_weekend: (r.order_cnt, r.total_revenue)
           for r in clean.weekend_trade(clean.dwd_order(o)).collect()}
    assert got == {1: (2, 3.0), 0: (1, 4.0)}


def test_orphan_order_keeps_null_user_attributes(spark):
    o = orders(spark, [(1, 1, "paid", "10", "a", "2026-05-02 00:00:00"),
                       (2, 99, "paid", "20", "a", "2026-05-02 00:00:00")])
    u = spark.createDataFrame([(1, "u1", "M", 30, "X", "2026-01-05", 2, None)], DIM_USER)
    vip = {r.vip_level: (r.user_cnt, r.order_cnt, r.total_revenue)
           for r in users.vip_analysis(clean.dwd_order(o), u).collect()}
    assert vip == {2: (1, 1, 10.0), None: (1, 1, 20.0)}
    coh = {r.register_month: r.registered_users
           for r in users.cohort_conversion(clean.dwd_order(o), u).collect()}
    assert coh == {"2026-01": 1, None: 1}


def test_bucket_edges(spark):
    rows, oid = [], 0
    for user, n in [(1, 1), (2, 2), (3, 3), (4, 5), (5, 6), (6, 10), (7, 11)]:
        for _ in range(n):
            oid += 1
            rows.append((oid, user, "paid", "1", "a", "2026-05-02 00:00:00"))
    base = users.rfm_base(clean.dwd_order(orders(spark, rows)), as_of="2026-05-03")
    got = {r.purchase_cnt: r.user_cnt for r in users.repurchase_dist(base).collect()}
    assert got == {"1": 1, "2": 1, "3-5": 2, "6-10": 2, ">10": 1}
    assert abs(sum(r.pct for r in users.repurchase_dist(base).collect()) - 100) < 0.5


def test_rfm_fixed_edges(spark):
    rows, oid = [], 0
    # (user, n orders, amount each, days before as_of)
    spec = [(1, 2, "100", 7), (2, 3, "100", 8), (3, 9, "1111.111", 30), (4, 10, "1000", 31),
            (5, 1, "9999.99", 1), (6, 1, "10000", 1), (7, 1, "49999.99", 1), (8, 1, "50000", 1), (9, 1, "100", 40)]
    as_of = dt.date(2026, 6, 1)
    for user, n, amt, days in spec:
        day = (as_of - dt.timedelta(days=days)).isoformat()
        for _ in range(n):
            oid += 1
            rows.append((oid, user, "paid", amt, "a", f"{day} 12:00:00"))
    rfm = {r.user_id: r for r in users.rfm_fixed(clean.dwd_order(orders(spark, rows)),
                                                  as_of=as_of.isoformat()).collect()}
    assert [rfm[u].r_score for u in (1, 2, 3, 4)] == [3, 2, 2, 1]
    assert [rfm[u].f_score for u in (1, 2, 3, 4)] == [1, 2, 2, 3]
    assert [rfm[u].m_score for u in (5, 6, 7, 8)] == [1, 2, 2, 3]
    assert rfm[8].rfm_total == 3 + 1 + 3 and rfm[8].user_tier == "high"
    assert rfm[1].user_tier == "mid" and rfm[2].user_tier == "mid" and rfm[9].user_tier == "low"


def test_terciles_when_all_users_equal(spark):
    rows = [(i, i, "paid", "5", "a", "2026-05-02 00:00:00") for i in range(1, 8)]
    base = users.rfm_base(clean.dwd_order(orders(spark, rows)), as_of="2026-05-03")
    th = users.rfm_thresholds(base).first()
    assert th.r_q33 == th.r_q66 == 1.0 and th.m_q33 == th.m_q66 == 5.0
    scored = users.rfm_tercile(base).collect()
    assert {(r.r_score, r.f_score, r.m_score, r.rfm_label) for r in scored} == {(3, 3, 3, "key_value")}


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(0, 997).select(((F.col("id") * 7919) % 1013 / 3.0).alias("x"),
                                    (F.col("id") % 5).alias("y"))
    from shoplake.operators.quantiles import exact_quantiles
    got = exact_quantiles(df, {"x": "x", "y": "y"}, [0.1, 0.33, 0.5, 0.66, 0.99], accuracy=50).first()
    ref = df.agg(F.percentile("x", [0.1, 0.33, 0.5, 0.66, 0.99]).alias("px"),
                 F.percentile("y", [0.1, 0.33, 0.5, 0.66, 0.99]).alias("py")).first()
    for i, p in enumerate([10, 33, 50, 66, 99]):
        assert got[f"x_q{p}"] == pytest.approx(ref.px[i], rel=1e-12)
        assert got[f"y_q{p}"] == pytest.approx(ref.py[i], rel=1e-12)


def _details(spark, rows):
    return spark.createDataFrame(
        [(i, o, p, q, None, s, None) for i, (o, p, q, s) in enumerate(rows)], FACT_ORDER_DETAIL)


def test_products_zero_price_and_missing_product(spark):
    p = spark.createDataFrame([
        (1, "a", "C1", "B1", 0.0, 5.0, 1, None, None),
        (2, "b", "C1", "B2", 10.0, 4.0, 1, None, None)], DIM_PRODUCT)
    top = {r.product_id: r for r in products.high_profit_top(p, 5).collect()}
    assert top[1].margin is None and top[2].margin == 60.0
    d = _details(spark, [(1, 1, 2, 10.0), (1, 2, 1, 10.0), (2, 3, 1, 7.0)])
    cats = {r.category: r for r in products.category_sales(d, p).collect()}
    assert cats["C1"].total_gmv == 20.0 and cats["C1"].total_profit == 20.0 - 10.0 - 4.0
    assert cats["C1"].sold_qty == 2 and cats["C1"].units_sold == 3 and cats["C1"].product_cnt == 2
    assert cats[None].product_cnt == 1 and cats[None].total_profit is None
    zero = _details(spark, [(1, 1, 1, 0.0)])
    assert products.category_sales(zero, p).first().profit_margin_pct is None


def test_brand_tie_broken_by_name(spark):
    p = spark.createDataFrame([(i, f"p{i}", "C", b, 1.0, 0.5, 1, None, None)
                               for i, b in enumerate(["Z", "A", "M", "Q"], start=1)], DIM_PRODUCT)
    d = _details(spark, [(1, 1, 1, 5.0), (1, 2, 1, 5.0), (2, 3, 1, 5.0), (2, 4, 1, 1.0)])
    top = products.brand_top3(d, p).orderBy("brand_rank").collect()
    assert [r.brand for r in top] == ["A", "M", "Z"]


def test_co_purchase_line_pairs_and_salting(spark):
    # product 10 on two lines of order 1, product 20 once: reference counts 2 line pairs
    d = _details(spark, [(1, 10, 1, 1.0), (1, 10, 1, 1.0), (1, 20, 1, 1.0), (2, 10, 1, 1.0),
                         (2, 20, 1, 1.0), (2, 30, 1, 1.0), (3, 40, 1, 1.0)])
    got = {(r.product_a, r.product_b): r.co_count for r in baskets.co_purchase(d).collect()}
    assert got == {(10, 20): 3, (10, 30): 1, (20, 30): 1}
    distinct = {(r.product_a, r.product_b): r.co_count
                for r in baskets.co_purchase(d, distinct_per_order=True).collect()}
    assert distinct[(10, 20)] == 2
    assert {r.order_id: r.basket_size for r in baskets.baskets(d).collect()} == {1: 3, 2: 3}
    # a basket far above the split size is spread over salt buckets: same answer
    big = _details(spark, [(1, p, 1, 1.0) for p in range(60)] + [(2, 1, 1, 1.0), (2, 2, 1, 1.0)])
    a = sorted(tuple(r) for r in baskets.co_purchase(big, split_above=7).collect())
    b = sorted(tuple(r) for r in baskets.co_purchase(big, split_above=None).collect())
    assert a == b and len(a) == 60 * 59 // 2


def test_empty_tables(spark):
    o = orders(spark, [])
    dwd = clean.dwd_order(o)
    assert trade.daily_trade(dwd).count() == 0
    assert trade.kpi_dashboard(dwd).first().total_orders == 0
    assert users.rfm_tercile(users.rfm_base(dwd, as_of="2026-01-01")).count() == 0
    assert baskets.co_purchase(_details(spark, [])).count() == 0


def test_row_gate(spark):
    u = spark.createDataFrame([(1, "u", "M", 1, "X", "2026-01-01", 0, None)], DIM_USER)
    gate = quality.row_gate(quality.table_row_counts({"dim_user": u}), {"dim_user": 100})
    assert gate.first().passed is False
    from shoplake.plans.jobs import enforce_gate
    with pytest.raises(RuntimeError):
        enforce_gate(gate)


def test_city_stats_rounding(spark):
    schema = StructType([StructField("user_id", LongType()), StructField("city", StringType()),
                         StructField("age", IntegerType()), StructField("vip_level", IntegerType())])
    u = spark.createDataFrame([(1, "A", 20, 1), (2, "A", 21, 2), (3, "A", 21, 2)], schema)
    r = users.city_stats(u).first()
    assert (r.user_cnt, r.avg_age, r.avg_vip) == (3, 21, 1.67)
    assert isinstance(users.city_stats(u).schema["avg_vip"].dataType, DoubleType)


def test_option_paths(spark):
    from conftest import SF_SMALL
    from shoplake.sources import bindings as B
    from shoplake.streaming.windows import behavior_uv_pv
    ev = B.user_behavior(spark, SF_SMALL)
    exact = {(r.window_start, r.behavior_type): (r.uv, r.pv) for r in behavior_uv_pv(ev).collect()}
    approx = {(r.window_start, r.behavior_type): (r.uv, r.pv)
              for r in behavior_uv_pv(ev, exact=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(exact[k][1] == approx[k][1] for k in exact)  # pv exact either way

    dwd = clean.dwd_order(B.fact_order(spark, SF_SMALL))
    base = users.rfm_base(dwd, as_of="2001-08-02")
    ex = users.rfm_thresholds(base).first()
    ap = users.rfm_thresholds(base, exact=False).first()
    assert abs(ex.f_q66 - ap.f_q66) <= 1.0

    u = B.dim_user(spark, SF_SMALL)
    buyers = {r.register_month: r for r in users.cohort_conversion(dwd, u).collect()}
    everyone = {r.register_month: r for r in users.cohort_conversion(dwd, u, "all_users").collect()}
    assert sum(r.registered_users for r in everyone.values()) == u.count()
    for m, r in buyers.items():
        if m is not None:
            assert everyone[m].first_month_buyers == r.first_month_buyers
            assert everyone[m].registered_users >= r.registered_users


def test_order_feed_fallback_and_samples(spark):
    schema = "order_id long, product_id long, actual_amount double"
    o = spark.createDataFrame([(1, 1, 10.0), (2, 1, 5.0), (3, 2, 1.0), (4, 9, 2.0)], schema)
    p = spark.createDataFrame([(1, "a", "C1", "B", 1.0, 0.5, 1, None, None),
                               (2, "b", "C2", "B", 1.0, 0.5, 1, None, None)], DIM_PRODUCT)
    got = {r.category: (r.product_cnt, r.order_cnt, r.total_gmv)
           for r in products.category_order_sales(o, p).collect()}
    assert got == {"C1": (1, 2, 15.0), "C2": (1, 1, 1.0), None: (1, 1, 2.0)}
    from shoplake.operators import ml
    recs = spark.createDataFrame([(u, i, 1.0 / i) for u in (5, 3, 9, 7) for i in (1, 2)],
                                 "user_id int, product_id int, score double")
    sample = ml.sample_recommendations(recs, 2)
    assert sorted({r.user_id for r in sample.collect()}) == [3, 5] and sample.count() == 4


def test_reconciliation(spark):
    d = spark.createDataFrame([(1, 1, 1, 2, 5.0, 10.0, None), (2, 1, 2, 3, 1.0, 7.5, None)],
                              FACT_ORDER_DETAIL)
    bad = quality.detail_reconciliation(d).collect()
    assert [r.detail_id for r in bad] == [2] and bad[0].expected_subtotal == 3.0


@pytest.mark.parametrize("reuse,aqe,parts", [("true", "true", 8), ("false", "true", 1), ("false", "false", 37)])
def test_exact_quantiles_do_not_depend_on_the_plan(spark, reuse, aqe, parts):
    from shoplake.operators.quantiles import exact_quantiles
    other = spark.newSession()
    for k, v in (("spark.sql.exchange.reuse", reuse), ("spark.sql.adaptive.enabled", aqe), ("spark.sql.shuffle.partitions", parts)):
        other.conf.set(k, str(v))
    df = other.range(0, 40_000, 1, 7).select(((F.col("id") * 7919) % 40_009).cast("double").alias("x"),
                                             F.lit(None).cast("double").alias("nothing"))
    got = exact_quantiles(df, {"x": "x", "nothing": "nothing"}, [0.33, 0.66])
    values = sorted((i * 7919) % 40_009 for i in range(40_000))
    assert got.first().nothing_q33 is None
    for p, v in ((0.33, got.first().x_q33), (0.66, got.first().x_q66)):
        pos = p * 39_999
        assert v == pytest.approx(values[int(pos)] + (values[int(pos) + 1] - values[int(pos)]) * (pos - int(pos)), rel=1e-12)
    assert got._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 4


def test_exact_quantiles_equal_pandas_bitwise(spark):
    import random

    import pandas as pd

    from shoplake.operators.quantiles import exact_quantiles
    rnd = random.Random(3)
    for trial in range(6):
        n = rnd.randint(3, 400)
        xs = [round(rnd.uniform(0, 3e6), 2) for _ in range(n)]
        ys = [rnd.randint(1, 20) for _ in range(n)]
        df = spark.createDataFrame(list(zip(xs, ys)), "x double, y long")
        got = exact_quantiles(df, {"x": "x", "y": "y"}, [0.33, 0.66], accuracy=100).first()
        for col, vals in (("x", xs), ("y", ys)):
            ref = pd.Series(vals, dtype="float64").quantile([0.33, 0.66])
            assert got[f"{col}_q33"] == ref.iloc[0] and got[f"{col}_q66"] == ref.iloc[1]
