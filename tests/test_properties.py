"""Cross-query properties on TESTDATA and randomised checks against brute force."""

from collections import Counter
from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplake.operators import baskets, ml
from shoplake.schemas import FACT_ORDER_DETAIL
from shoplake.sources import bindings as B

Q = E.queries()


def test_shares_sum_to_100(spark):
    assert abs(sum(r.pct for r in Q["payment_share"](spark, SF_SMALL).collect()) - 100) < 1
    assert abs(sum(r.pct for r in Q["repurchase_dist"](spark, SF_SMALL).collect()) - 100) < 1


def test_daily_rows_add_up_to_kpi(spark):
    daily = Q["daily_trade"](spark, SF_SMALL).agg(
        F.sum("order_cnt").alias("n"), F.sum("total_revenue").alias("rev")).first()
    kpi = Q["kpi_dashboard"](spark, SF_SMALL).first()
    assert daily.n == kpi.total_orders
    assert abs(daily.rev - kpi.total_revenue) < 0.01
    rej = Q["rejected_orders"](spark, SF_SMALL).first()
    assert rej.kept == kpi.total_orders and rej.kept + rej.rejected == rej.total


def test_scores_and_labels_in_domain(spark):
    for name in ("rfm_fixed", "rfm_tercile"):
        df = Q[name](spark, SF_SMALL)
        bad = df.where(~F.col("r_score").between(1, 3) | ~F.col("f_score").between(1, 3)
                       | ~F.col("m_score").between(1, 3))
        assert bad.count() == 0
    labels = {r.rfm_label for r in Q["rfm_summary"](spark, SF_SMALL).collect()}
    assert labels <= {"key_value", "key_develop", "key_retain", "key_win_back", "general_value",
                      "general_retain", "lost", "new"}


def test_pairs_are_ordered_and_counts_consistent(spark):
    pairs = Q["co_purchase"](spark, SF_SMALL)
    assert pairs.where(F.col("product_a") >= F.col("product_b")).count() == 0
    top = Q["top_co_purchase"](spark, SF_SMALL).collect()
    best = pairs.agg(F.max("co_count")).first()[0]
    assert top[0].co_count == best or max(r.co_count for r in top) == best


def test_category_rollup_matches_lines(spark):
    cats = Q["category_sales"](spark, SF_SMALL).agg(F.sum("sold_qty"), F.sum("units_sold")).first()
    lines = B.fact_order_detail(spark, SF_SMALL).agg(F.count("detail_id"), F.sum("quantity")).first()
    assert tuple(cats) == tuple(lines)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 9)), min_size=0, max_size=40),
       st.sampled_from([1, 2, 3, None]))
def test_co_purchase_equals_brute_force(spark, lines, split):
    rows = [(i, o, p, 1, None, 1.0, None) for i, (o, p) in enumerate(lines)]
    d = spark.createDataFrame(rows, FACT_ORDER_DETAIL)
    got = {(r.product_a, r.product_b): r.co_count
           for r in baskets.co_purchase(d, split_above=split).collect()}
    expect = Counter()
    by_order = {}
    for o, p in lines:
        by_order.setdefault(o, []).append(p)
    for prods in by_order.values():
        for a, b in combinations(prods, 2):   # every line pair, as the reference counts
            if a != b:
                expect[(min(a, b), max(a, b))] += 1
    assert got == dict(expect)


def test_als_rerun_is_deterministic(spark):
    r = ml.ratings(B.fact_order_detail(spark, SF_SMALL), B.fact_order(spark, SF_SMALL))
    _, n1, m1, rmse1 = ml.als_fit_evaluate(r)
    _, n2, m2, rmse2 = ml.als_fit_evaluate(r)
    assert (n1, m1) == (n2, m2) and abs(rmse1 - rmse2) < 1e-9


def test_hot_order_holding_a_third_of_lines(spark):
    lines = B.fact_order_detail(spark, SF_SMALL)
    # every third line is moved into one order: a single key with a third of all rows
    third = F.pmod(F.xxhash64("order_id", "product_id", "detail_id"), F.lit(3)) == 0
    hot = lines.withColumn("order_id", F.when(third, F.lit(-1).cast("long"))
                           .otherwise(F.col("order_id")))
    assert hot.where("order_id = -1").count() * 3 >= lines.count() * 0.9
    salted = baskets.co_purchase(hot, split_above=16)
    plain = baskets.co_purchase(hot, split_above=None)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    orders = B.fact_order(spark, SF_SMALL).unionByName(
        B.fact_order(spark, SF_SMALL).limit(1).withColumn("order_id", F.lit(-1).cast("long")))
    # per-task rows: the lookup deals the hot order to many parts, and so does the salted join
    parts = hot.where("order_id = -1").select("product_id").distinct().groupBy(
        F.pmod(F.xxhash64("product_id"), F.lit(baskets.LOOKUP_PARTS))).count()
    n = hot.where("order_id = -1").select("product_id").distinct().count()
    assert parts.agg(F.max("count")).first()[0] <= max(8, 4 * n / baskets.LOOKUP_PARTS)
    r = ml.ratings(hot, orders)
    assert r.agg(F.sum("purchase_count")).first()[0] > 0


def _py_rfm(rows, as_of):
    """Plain-Python reference rules over (order_id, user, status, amount, date) rows."""
    import pandas as pd
    valid = [r for r in rows if r[2] in ("paid", "shipped", "completed") and r[3] > 0]
    users = {}
    for _, u, _, amt, d in valid:
        f = users.setdefault(u, [0, 0, None])
        f[0] += 1
        f[1] += round(amt * 100)
        f[2] = d if f[2] is None or d > f[2] else f[2]
    out = {}
    for u, (n, cents, last) in users.items():
        rec = (as_of - last).days
        money = cents / 100
        r = 3 if rec <= 7 else 2 if rec <= 30 else 1
        f = 3 if n >= 10 else 2 if n >= 3 else 1
        m = 3 if money >= 50000 else 2 if money >= 10000 else 1
        t = r + f + m
        out[u] = {"freq": n, "money": money, "rec": rec, "fixed": (r, f, m, t,
                  "high" if t >= 7 else "mid" if t >= 5 else "low")}
    if out:
        df = pd.DataFrame([(v["rec"], v["freq"], v["money"]) for v in out.values()],
                          columns=["r", "f", "m"]).astype("float64")
        q = {c: df[c].quantile([0.33, 0.66]).tolist() for c in "rfm"}
        for v in out.values():
            r = 3 if v["rec"] <= q["r"][0] else 2 if v["rec"] <= q["r"][1] else 1
            f = 3 if v["freq"] >= q["f"][1] else 2 if v["freq"] >= q["f"][0] else 1
            m = 3 if v["money"] >= q["m"][1] else 2 if v["money"] >= q["m"][0] else 1
            v["tercile"] = (r, f, m)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 8), st.sampled_from(["paid", "shipped", "completed",
                                                              "pending", "cancelled"]),
                          st.integers(-500, 6_000_000), st.integers(0, 60)),
                min_size=1, max_size=60))
def test_rfm_matches_python_rules(spark, draws):
    import datetime as dt

    from shoplake.operators import clean, users
    as_of = dt.date(2026, 6, 1)
    rows = [(i, u, s, cents / 100, as_of - dt.timedelta(days=back))
            for i, (u, s, cents, back) in enumerate(draws)]
    text = [(i, u, s, f"{a:.2f}", "0", f"{a:.2f}", "card", f"{d.isoformat()} 08:00:00")
            for i, u, s, a, d in rows]
    schema = ("order_id long, user_id long, order_status string, order_amount string, "
              "discount_amount string, actual_amount string, payment_method string, "
              "order_time string")
    dwd = clean.dwd_order(spark.createDataFrame(text, schema))
    want = _py_rfm(rows, as_of)
    fixed = {r.user_id: (r.r_score, r.f_score, r.m_score, r.rfm_total, r.user_tier)
             for r in users.rfm_fixed(dwd, as_of=as_of.isoformat()).collect()}
    assert fixed == {u: v["fixed"] for u, v in want.items()}
    terc = {r.user_id: (r.r_score, r.f_score, r.m_score)
            for r in users.rfm_tercile(users.rfm_base(dwd, as_of=as_of.isoformat())).collect()}
    assert terc == {u: v["tercile"] for u, v in want.items()}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 120)), min_size=1, max_size=50),
       st.lists(st.integers(0, 120), min_size=6, max_size=6))
def test_repurchase_and_cohorts_match_python_rules(spark, draws, reg_days):
    import datetime as dt

    from shoplake.operators import clean, users
    day0 = dt.date(2026, 1, 1)
    text = [(i, u, "paid", "10.00", "0", "10.00", "card",
             f"{(day0 + dt.timedelta(days=d)).isoformat()} 08:00:00")
            for i, (u, d) in enumerate(draws)]
    schema = ("order_id long, user_id long, order_status string, order_amount string, "
              "discount_amount string, actual_amount string, payment_method string, "
              "order_time string")
    dwd = clean.dwd_order(spark.createDataFrame(text, schema))
    # users 1..6 are registered; 7..9 are orphans
    regs = {u: day0 + dt.timedelta(days=reg_days[u - 1]) for u in range(1, 7)}
    u_df = spark.createDataFrame(
        [(u, f"u{u}", "M", 30, "X", d.isoformat(), 0, None) for u, d in regs.items()],
        "user_id long, user_name string, gender string, age int, city string, "
        "register_date string, vip_level int, create_time string")

    counts, first = {}, {}
    for u, d in draws:
        day = day0 + dt.timedelta(days=d)
        counts[u] = counts.get(u, 0) + 1
        first[u] = min(first.get(u, day), day)

    def bucket(n):
        return "1" if n == 1 else "2" if n == 2 else "3-5" if n <= 5 else "6-10" if n <= 10 else ">10"
    want_b = {}
    for n in counts.values():
        want_b[bucket(n)] = want_b.get(bucket(n), 0) + 1
    base = users.rfm_base(dwd, as_of="2026-12-31")
    got_b = {r.purchase_cnt: r.user_cnt for r in users.repurchase_dist(base).collect()}
    assert got_b == want_b

    want_c = {}
    for u, f in first.items():
        month = regs[u].strftime("%Y-%m") if u in regs else None
        reg, conv = want_c.get(month, (0, 0))
        want_c[month] = (reg + 1, conv + (month == f.strftime("%Y-%m")))
    got_c = {r.register_month: (r.registered_users, r.first_month_buyers)
             for r in users.cohort_conversion(dwd, u_df).collect()}
    assert got_c == want_c
