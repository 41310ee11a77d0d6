"""Mergeable states, nested orders as a stream, and late rows as an output."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplake.operators import ml, rollups
from shoplake.sources import bindings as B
from shoplake.streaming import io as sio
from shoplake.streaming import late, windows
from test_streaming import SCHEMA, _run, _write_batches


def test_merged_sketches_stay_within_their_rank_error(spark):
    rng = random.Random(1)
    rows = [(i % 40, (i % 40) // 20, rng.paretovariate(1.2)) for i in range(20_000)] + [(3, 0, None)] * 50 + [(99, 9, None)]
    df = spark.createDataFrame(rows, "day int, month int, v double")
    days = rollups.quantile_sketches(df, ["day", "month"], {"v": "v"}, k=200)
    probs = (0.0, 0.1, 0.5, 0.99, 1.0)
    for keys in (["month"], []):
        q = rollups.sketch_quantiles(rollups.merged_sketches(days, keys, ["v"], 200), keys, ["v"], probs)
        if keys:
            nine = q.where("month = 9").first()
            assert nine["v_n"] in (0, None) and nine["v_q50"] is None
            err = rollups.quantile_errors(df, keys, {"v": "v"}, q, probs).collect()
            assert len(err) == 10 and max(r.rank_error for r in err) <= 2 * rollups.rank_error(200)
            assert {r.n for r in err} == {10_000}
        else:
            assert q.first()["v_n"] == 20_000


def test_quantile_errors_notice_wrong_values(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    wrong = spark.createDataFrame([(1, 1000, 700.0)], "k int, v_n bigint, v_q50 double")
    assert abs(rollups.quantile_errors(df, ["k"], {"v": "v"}, wrong, (0.5,)).first()["rank_error"] - 0.2) < 1e-9


def test_bitmaps_and_states_roll_up(spark):
    rng = random.Random(2)
    rows = [(i % 50, (i % 50) // 10, rng.choice([None, *range(0, 70_000, 7), 0, 32_767, 32_768])) for i in range(30_000)]
    df = spark.createDataFrame(rows, "minute int, day int, id int")
    want = {r.day: r.uv for r in df.groupBy("day").agg(F.count_distinct("id").alias("uv")).collect()}
    fine = rollups.distinct_bitmaps(df, ["minute", "day"], "id")
    got = rollups.bitmap_counts(rollups.merged_bitmaps(fine, ["day"]), ["day"])
    assert {r.day: r.uv for r in got.collect()} == want
    states = rollups.distinct_states(df, ["minute", "day"], "id")
    near = {r.day: r.uv for r in rollups.state_counts(states, ["day"]).collect()}
    assert set(near) == set(want) and all(abs(near[d] / want[d] - 1) < 0.03 for d in want)


def test_sketched_thresholds_are_near_the_exact_ones(spark):
    from shoplake.operators import clean, users
    base = users.rfm_base(clean.dwd_order(B.fact_order(spark, SF_SMALL)), "2001-08-02")
    a, b = users.rfm_thresholds(base).first(), users.rfm_thresholds(base, exact=False).first()
    assert a.asDict().keys() == b.asDict().keys()
    assert all(abs(a[c] - b[c]) <= 0.1 * abs(a[c]) + 1 for c in a.asDict())


# --- nested items -----------------------------------------------------------------------------------------------------

def _lines(df):
    return sorted(tuple(r) for r in df.collect())


def test_nested_orders_are_bounded_and_whole(spark):
    orders = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "no lines")], "order_id bigint, note string")
    rows = [(1, i, i % 7, 1) for i in range(3000)] + [(2, 1, 5, 2), (2, 2, 5, 2), (3, 1, None, None), (9, 1, 1, 1)]
    details = spark.createDataFrame(rows, "order_id bigint, detail_id bigint, product_id bigint, quantity bigint")
    nested = windows.nested_orders(orders, details, ["detail_id", "product_id", "quantity"], limit=100)
    sizes = nested.select("order_id", F.size("items").alias("n")).collect()
    assert max(r.n for r in sizes) <= 100 and len([r for r in sizes if r.order_id == 1]) > 30
    got = windows.explode_order_items(nested.select("order_id", "items")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(r) for r in rows if r[0] != 9)


def test_item_stream_equals_batch(spark):
    orders = B.fact_order(spark, SF_SMALL).select("order_id", "order_time")
    nested = windows.nested_orders(orders, B.fact_order_detail(spark, SF_SMALL), ["product_id", "quantity", "subtotal"])
    path = os.path.join(tempfile.mkdtemp(prefix="shoplake-items-"), "orders")
    nested.unionByName(orders.limit(3).withColumn("part", F.lit(9)).withColumn("items", F.lit(None))).write.parquet(path)
    got = sio.stream_item_totals(spark, path, {"order_time": sio.SENTINEL_TIME})
    assert _lines(got) == _lines(windows.item_window_totals(spark.read.parquet(path)))


# --- late rows ----------------------------------------------------------------------------------------------------------

V, BUY = "view", "buy"
TRACES = [
    ([[(1, 1, V), (2, 1, V), (3, 2, V), (4, None, V), (30, 3, BUY)], [(66, 1, V), (50, 9, V)], [(10, 8, V), (130, 1, V)], [(300, 1, BUY)]], []),
    ([[(1, 1, V), (2, 1, V)], [(66, 1, V), (50, 9, V)], [(130, 1, V)], [(10, 8, V), (300, 1, BUY)], [(400, 1, BUY)]], [(3, 8)]),
]


@pytest.mark.parametrize("batches,late_users", TRACES)
@pytest.mark.parametrize("stops", [[], [2]])
def test_kept_and_late_rows_are_the_input(spark, batches, late_users, stops):
    root = tempfile.mkdtemp(prefix="shoplake-late-")
    src, out = os.path.join(root, "src"), os.path.join(root, "out")
    os.makedirs(src)
    for upto in [*stops, len(batches)]:                                      # a stop and a restart on the same checkpoint
        _write_batches(src, batches[:upto])
        stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
                  .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").json(src))
        q = late.start_split(stream, out, os.path.join(root, "ckpt"), "behavior_time", delay="5 seconds", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    kept, rest = late.kept_rows(spark, out, SCHEMA), late.late_rows(spark, out, SCHEMA)
    assert sorted((r.batch, r.user_id) for r in rest.collect()) == late_users
    sent = sorted(str((u, b, s)) for rows in batches for s, u, b in rows)
    both = kept.select("user_id", "behavior_type", F.expr("unix_timestamp(behavior_time) % 3600")).unionByName(
        rest.select("user_id", "behavior_type", F.expr("unix_timestamp(behavior_time) % 3600")))
    assert sorted(str(tuple(r)) for r in both.collect()) == sent
    # the kept rows give the windows that the dropping stream gives, and the late ones are those it counts
    native, dropped = _run(spark, batches)
    totals = windows.behavior_uv_pv(kept)
    mine = {(r.window_start.strftime("%H:%M"), r.behavior_type, r.uv, r.pv) for r in totals.collect()}
    assert set(native) <= mine and dropped == len(late_users)


def test_a_batch_that_runs_again_replaces_its_rows(spark):
    root = tempfile.mkdtemp(prefix="shoplake-late-")
    write = late._writer(root, "at", "1 minute", "5 seconds")
    for batch_id, hours in ((0, [1]), (1, [2]), (2, [0, 3]), (2, [0, 3]), (3, [1, None])):
        rows = spark.createDataFrame([(h,) for h in hours], "h int").select(
            F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, h)").alias("at"), "h")
        write(rows, batch_id)
    schema = rows.schema
    assert sorted((r.batch, r.h) for r in late.kept_rows(spark, root, schema).collect()) == [(0, 1), (1, 2), (2, 3)]
    assert sorted((r.batch, -1 if r.h is None else r.h) for r in late.late_rows(spark, root, schema).collect()) == [(2, 0), (3, -1), (3, 1)]


def test_dense_ids_feed_the_bitmaps(spark):
    ids = ml.dense_ids(spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "u string"), "u").collect()
    assert sorted(r.u_idx for r in ids) == [0, 1]
