"""User analysis: geography, VIP, RFM (fixed and tercile), repurchase, cohorts.

Per-user facts are aggregated from the orders *before* any join with the user
dimension, so the dimension join sees one row per user instead of one per
order.  Dimension joins carry no forced broadcast: Catalyst broadcasts the
user table only if its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks the real size at
runtime; beyond it the join is a shuffle (sort-merge) join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.columns import money_avg, month_key, percent, to_date_safe, to_money
from shoplake.functions.labels import (ORDER_COUNT, PURCHASE_BUCKETS, RECENCY_DAYS,
                                       RFM_DEFAULT_LABEL, RFM_LABEL_RULES, SPEND,
                                       TERCILE_PROBS, TIER_CUTOFFS, TIER_LABELS)
from shoplake.operators.quantiles import exact_quantiles, quantile_name
from shoplake.operators.rollups import quantile_sketches, sketch_quantiles
from shoplake.session import stored_table
from shoplake.plans.joins import dim_join


def _as_of(as_of) -> Column:
    return F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))


def city_stats(users: DataFrame) -> DataFrame:
    """Users, mean age (integer) and mean VIP level per city."""
    return users.groupBy("city").agg(
        F.count("user_id").alias("user_cnt"),
        F.round(F.avg("age"), 0).cast("int").alias("avg_age"),
        F.round(F.avg("vip_level"), 2).alias("avg_vip"))


def top_cities(users: DataFrame, k: int = 10) -> DataFrame:
    """The k cities with most users (ties by name)."""
    return city_stats(users).orderBy(F.col("user_cnt").desc(), F.col("city").asc()).limit(k)


def user_order_facts(dwd: DataFrame) -> DataFrame:
    """Per-user order facts every per-user result derives from (one aggregation of the orders).

    ``revenue`` stays DECIMAL (exact); ``n_amounts`` counts non-NULL amounts
    so means skip NULLs as ``avg`` does.
    """
    return dwd.groupBy("user_id").agg(
        F.count("order_id").alias("n_orders"),
        F.sum(to_money("actual_amount")).alias("revenue"),
        F.count("actual_amount").alias("n_amounts"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))


def _facts(dwd: DataFrame | None, facts: DataFrame | None) -> DataFrame:
    return facts if facts is not None else user_order_facts(dwd)


def user_orders(dwd: DataFrame, users: DataFrame, broadcast: bool = True) -> DataFrame:
    """Orders LEFT JOIN users (orphan orders keep NULL user attributes)."""
    dims = users.select("user_id", "city", "vip_level", "register_date")
    return dim_join(dwd, dims, "user_id", broadcast=broadcast)


def vip_analysis(dwd: DataFrame | None, users: DataFrame, broadcast: bool = True,
                 facts: DataFrame | None = None) -> DataFrame:
    """Per VIP level users, orders, revenue, AOV and ARPU.

    Orders are first reduced to one row per user (count and exact revenue),
    then joined to the VIP level, then summed per level.  Users are counted
    distinctly: a user table with repeated keys multiplies orders and revenue, as
    any join does, but not users.
    """
    per_user = _facts(dwd, facts)
    joined = dim_join(per_user, users.select("user_id", "vip_level"), "user_id",
                      broadcast=broadcast)
    agg = joined.groupBy("vip_level").agg(
        F.count_distinct("user_id").alias("user_cnt"),
        F.sum("n_orders").alias("order_cnt"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("n_amounts").alias("n_amounts"))
    return agg.select(
        "vip_level", "user_cnt", "order_cnt", "total_revenue",
        F.round(F.try_divide(F.col("total_revenue"), F.col("n_amounts")), 2).alias("avg_order_value"),
        F.round(F.try_divide(F.col("total_revenue"), F.col("user_cnt")), 2).alias("arpu"))


def user_spending(dwd: DataFrame | None, facts: DataFrame | None = None) -> DataFrame:
    """A3: orders, spend, mean order and last order date per user."""
    f = _facts(dwd, facts)
    spent = F.col("revenue").cast("double")
    return f.select("user_id", F.col("n_orders").alias("order_cnt"), spent.alias("total_spent"),
                    F.round(F.try_divide(spent, F.col("n_amounts")), 2).alias("avg_per_order"),
                    "last_order_date")


def _score_low_is_good(c: Column, cuts: Sequence) -> Column:
    return F.when(c <= cuts[0], 3).when(c <= cuts[1], 2).otherwise(1)


def _score_high_is_good(c: Column, cuts: Sequence) -> Column:
    return F.when(c >= cuts[0], 3).when(c >= cuts[1], 2).otherwise(1)


def rfm_fixed(dwd: DataFrame | None, as_of=None, r=RECENCY_DAYS, f=ORDER_COUNT, m=SPEND,
              tiers=TIER_CUTOFFS, labels=TIER_LABELS, facts: DataFrame | None = None) -> DataFrame:
    """Fixed-threshold RFM scores, total and tier per user."""
    base = user_spending(dwd, facts).withColumn(
        "recency_days", F.datediff(_as_of(as_of), F.col("last_order_date")))
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return (base
            .withColumn("r_score", _score_low_is_good(F.col("recency_days"), r).cast("int"))
            .withColumn("f_score", _score_high_is_good(F.col("order_cnt"), f).cast("int"))
            .withColumn("m_score", _score_high_is_good(F.col("total_spent"), m).cast("int"))
            .withColumn("rfm_total", total.cast("int"))
            .withColumn("user_tier", F.when(F.col("rfm_total") >= tiers[0], labels[0])
                        .when(F.col("rfm_total") >= tiers[1], labels[1]).otherwise(labels[2])))


def tier_summary(rfm: DataFrame) -> DataFrame:
    """A5: users, mean spend and mean orders per tier (input: ``rfm_fixed``)."""
    return rfm.groupBy("user_tier").agg(
        F.count("user_id").alias("user_cnt"),
        money_avg("total_spent").alias("avg_spent"),
        F.round(F.try_divide(F.sum("order_cnt").cast("double"), F.count("order_cnt")), 1)
        .alias("avg_orders"))


def top_high_value_users(rfm: DataFrame, k: int = 10, tier: str = TIER_LABELS[0]) -> DataFrame:
    """The k biggest spenders of the top tier (ties by user id)."""
    return (rfm.where(F.col("user_tier") == tier)
            .orderBy(F.col("total_spent").desc(), F.col("user_id").asc())
            .select("user_id", "order_cnt", "total_spent", "recency_days", "rfm_total")
            .limit(k))


def rfm_base(dwd: DataFrame | None, as_of=None, facts: DataFrame | None = None) -> DataFrame:
    """Frequency, monetary, last date and recency per user."""
    return (_facts(dwd, facts).select(
                "user_id", F.col("n_orders").alias("frequency"),
                F.col("revenue").cast("double").alias("monetary"), "last_order_date")
            .withColumn("recency", F.datediff(_as_of(as_of), F.col("last_order_date"))))


RFM_MEASURES = {"r": "recency", "f": "frequency", "m": "monetary"}


def rfm_thresholds(base: DataFrame, probs: Sequence[float] = TERCILE_PROBS,
                   exact: bool = True) -> DataFrame:
    """A10: one row ``r_q33, r_q66, f_q33, f_q66, m_q33, m_q66`` (input: ``rfm_base``).

    ``exact=True`` interpolates like pandas ``quantile`` / ``percentile``,
    distributed (see ``exact_quantiles``); ``exact=False`` reads them off KLL
    sketches (see ``rollups``), whose states can be stored per key and merged.
    """
    measures = RFM_MEASURES
    if exact:
        # two passes over the values: the base is read once
        return exact_quantiles(stored_table(base.select(*measures.values()), "rfm-measures"), measures, probs)
    sketches = quantile_sketches(base, [], measures)
    return sketch_quantiles(sketches, [], list(measures), probs).select(
        *[quantile_name(m, p) for m in measures for p in probs])


def _tercile_label() -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for condition, label in RFM_LABEL_RULES:
        out = out.when(F.expr(condition), label)
    return out.otherwise(RFM_DEFAULT_LABEL)


def rfm_tercile(base: DataFrame, thresholds: DataFrame | None = None,
                probs: Sequence[float] = TERCILE_PROBS) -> DataFrame:
    """Tercile scores and the eight-way label per user (input: ``rfm_base``).

    The one-row threshold table enters as a scalar subquery (evaluated once,
    inlined as constants): no join and no single-partition step.
    """
    if thresholds is None:
        base = stored_table(base, "rfm-base")               # read once; thresholds and scores work on the result
        thresholds = exact_quantiles(base, RFM_MEASURES, probs)
    lo, hi = probs[0], probs[1]

    def q(m, p):
        return F.col("_th").getField(quantile_name(m, p))

    # one scalar subquery, projected once as a struct column, read field by field
    th = thresholds.select(F.struct("*").alias("t")).scalar()
    return (base.withColumn("_th", th)
            .withColumn("r_score", _score_low_is_good(F.col("recency"), (q("r", lo), q("r", hi))).cast("int"))
            .withColumn("f_score", _score_high_is_good(F.col("frequency"), (q("f", hi), q("f", lo))).cast("int"))
            .withColumn("m_score", _score_high_is_good(F.col("monetary"), (q("m", hi), q("m", lo))).cast("int"))
            .drop("_th")
            .withColumn("rfm_label", _tercile_label()))


def rfm_summary(scored: DataFrame) -> DataFrame:
    """Users and mean R/F/M per label (input: ``rfm_tercile``)."""
    return scored.groupBy("rfm_label").agg(
        F.count("user_id").alias("user_cnt"),
        F.round(F.try_divide(F.sum("frequency").cast("double"), F.count("frequency")), 1)
        .alias("avg_freq"),
        money_avg("monetary").alias("avg_money"),
        F.round(F.try_divide(F.sum("recency").cast("double"), F.count("recency")), 0)
        .alias("avg_recency_days"))


def purchase_bucket(freq: Column, labels=PURCHASE_BUCKETS) -> Column:
    return (F.when(freq == 1, labels[0]).when(freq == 2, labels[1])
            .when(freq.between(3, 5), labels[2]).when(freq.between(6, 10), labels[3])
            .otherwise(labels[4]))


def repurchase_dist(base: DataFrame, labels=PURCHASE_BUCKETS) -> DataFrame:
    """Users per purchase-count bucket and their share (input: ``rfm_base``)."""
    per_bucket = (base.groupBy(purchase_bucket(F.col("frequency"), labels).alias("purchase_cnt"))
                  .agg(F.count("user_id").alias("user_cnt")))
    total = F.sum("user_cnt").over(Window.partitionBy())
    return per_bucket.select("purchase_cnt", "user_cnt", percent("user_cnt", total, 1).alias("pct"))


def bucket_order(labels=PURCHASE_BUCKETS) -> Column:
    """Sort key that lists buckets in their natural order."""
    c = F.col("purchase_cnt")
    out = F.when(c == labels[0], 1)
    for i, lab in enumerate(labels[1:-1], start=2):
        out = out.when(c == lab, i)
    return out.otherwise(len(labels))


def _register_month(users: DataFrame) -> Column:
    return month_key(to_date_safe("register_date", users.schema["register_date"].dataType))


def first_order(dwd: DataFrame | None, users: DataFrame, broadcast: bool = True,
                facts: DataFrame | None = None) -> DataFrame:
    """First order date and month per user, with the registration month.

    The first order is taken per user before the join, so the join carries
    one row per user and registration month; repeated rows of the user table count once.
    """
    firsts = _facts(dwd, facts).select("user_id", "first_order_date")
    regs = users.select("user_id", _register_month(users).alias("register_month")).distinct()
    return (dim_join(firsts, regs, "user_id", broadcast=broadcast)
            .select("user_id", "register_month", "first_order_date",
                    month_key("first_order_date").alias("first_order_month")))


def cohort_conversion(dwd: DataFrame | None, users: DataFrame, denominator: str = "buyers",
                      broadcast: bool = True, facts: DataFrame | None = None) -> DataFrame:
    """Per registration month, users and first-month buyers.

    ``denominator="buyers"`` (reference) counts only users who ordered;
    ``"all_users"`` counts every registered user of the month.
    """
    fo = first_order(dwd, users, broadcast, facts)
    converted = F.col("first_order_month") == F.col("register_month")
    per_month = fo.groupBy("register_month").agg(
        F.count_distinct("user_id").alias("registered_users"),
        F.count_distinct(F.when(converted, F.col("user_id"))).alias("first_month_buyers"))
    if denominator == "all_users":
        regs = (users.groupBy(_register_month(users).alias("register_month"))
                .agg(F.count("user_id").alias("registered_users")))
        per_month = (regs.join(per_month.drop("registered_users"), "register_month", "left")
                     .fillna(0, ["first_month_buyers"]))
    elif denominator != "buyers":
        raise ValueError(f"unknown denominator {denominator!r}")
    return per_month.select(
        "register_month", "registered_users", "first_month_buyers",
        percent("first_month_buyers", "registered_users", 1).alias("conversion_rate"))
