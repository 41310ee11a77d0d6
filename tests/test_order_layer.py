"""The partitioned order layer: pruned folders, Bloom filter, hot days."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplake.operators import clean
from shoplake.session import stored_table
from shoplake.sources import bindings as B
from shoplake.sources import commits, layer


def _layer(spark, dwd):
    path = os.path.join(tempfile.mkdtemp(prefix="shoplake-layer-"), "dwd")
    layer.write_order_layer(dwd, path)
    return path, layer.read_order_layer(spark, path, dwd.schema)


def test_chosen_days_prune_the_scan_and_lines_meet_a_bloom_filter(spark):
    dwd = clean.dwd_order(B.fact_order(spark, SF_SMALL))
    dwd = dwd.where(F.col("order_date") < F.lit(dwd.agg(F.min("order_date") + F.expr("INTERVAL 90 DAYS")).first()[0]))
    _, orders = _layer(spark, dwd)
    assert sorted(map(str, orders.select(*dwd.columns).collect())) == sorted(map(str, dwd.collect()))
    days = stored_table(layer.calendar(dwd), "days").where("is_weekend = 1")
    conf = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    lines = B.fact_order_detail(spark, SF_SMALL)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        totals = layer.day_totals(orders, days, lines)
        plan = totals._jdf.queryExecution().sparkPlan().toString()
        assert "dynamicpruning" in plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = lines.join(dwd.where("user_id = 1"), "order_id")
        assert "might_contain" in joined._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    got = {r.order_date: (r.order_cnt, r.line_cnt) for r in totals.collect()}
    weekend = dwd.where(F.dayofweek("order_date").isin(1, 7))
    want = {r.order_date: r.n for r in weekend.groupBy("order_date").agg(F.count("*").alias("n")).collect()}
    assert {d: n for d, (n, _) in got.items()} == want
    assert sum(n for _, n in got.values()) == lines.join(weekend, "order_id").count()


def test_orders_without_date_and_a_hot_day(spark):
    rows = [(i, i % 5, "paid", 1.0, 0.0, 1.0, "x", "2024-01-06" if i % 3 else None if i % 2 else "2024-01-08") for i in range(600)]
    dwd = spark.createDataFrame(rows, "order_id bigint, user_id bigint, order_status string, order_amount double, "
                                "discount_amount double, actual_amount double, payment_method string, d string").withColumn(
        "order_date", F.to_date("d")).drop("d")
    path, orders = _layer(spark, dwd)
    assert orders.count() == 600 and orders.where("order_date is null").count() == 100
    days = layer.calendar(dwd)
    assert [str(r.order_date) for r in days.orderBy("order_date").collect()] == ["2024-01-06", "2024-01-07", "2024-01-08"]
    got = {str(r.order_date): (r.order_cnt, r.total_revenue, r.line_cnt) for r in layer.day_totals(
        orders, days, spark.createDataFrame([(1, 1), (1, 2), (999, 1)], "order_id bigint, detail_id bigint")).collect()}
    assert got == {"2024-01-06": (400, 400.0, 2), "2024-01-08": (100, 100.0, 0)}
    layer.write_order_layer(dwd.limit(3), path)
    assert layer.read_order_layer(spark, path, dwd.schema).count() == 3 and commits.prune(spark, path, keep=1) == 1
    assert layer.calendar(dwd.limit(0)).count() == 0
