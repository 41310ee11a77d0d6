"""Facts FIXTURES.md records for TESTDATA at sf0.01, recomputed through our bindings and operators."""

import os

import pytest
from pyspark.sql import functions as F

from shoplake.operators import baskets, clean
from shoplake.sources import bindings as B

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sf0.01 not present")


def test_order_facts(spark):
    o = B.fact_order(spark, SF)
    assert o.count() == 15000
    by = {r.order_status: r["count"] for r in o.groupBy("order_status").count().collect()}
    assert by == {"completed": 4933, "paid": 4979, "pending": 5088}
    dwd = clean.dwd_order(o)
    assert dwd.select("user_id").distinct().count() == 1497
    per_user = dwd.groupBy("user_id").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(per_user) == (1, 17)
    amounts = o.agg(F.min("actual_amount"), F.max("actual_amount")).first()
    assert float(amounts[0]) == 981.56 and float(amounts[1]) == 499935.59


def test_user_product_event_facts(spark):
    assert B.dim_user(spark, SF).count() == 1500
    p = B.dim_product(spark, SF)
    assert p.count() == 2000
    assert p.select("category").distinct().count() == 6
    assert p.select("brand").distinct().count() == 25
    cost = p.agg(F.min("cost"), F.max("cost")).first()
    assert float(cost[0]) == 140.90 and float(cost[1]) == 870.00
    ev = B.user_behavior(spark, SF)
    assert ev.count() == 10000
    assert ev.select("behavior_type").distinct().count() == 5
    assert ev.select("user_id").distinct().count() == 150


def test_line_and_pair_facts(spark):
    d = B.fact_order_detail(spark, SF)
    assert d.count() == 60000
    repeated = d.groupBy("order_id", "product_id").count().where("count > 1")
    assert repeated.count() == 55
    pairs = baskets.co_purchase(d)
    assert pairs.count() == 115729                                  # distinct pairs
    assert pairs.agg(F.sum("co_count")).first()[0] == 119443          # line pairs
