"""Top pairs by threshold, norm-bounded top-k and checked fits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplake.operators import baskets, clean, ml
from shoplake.sources import bindings as B


def _lines(spark, rows):
    return spark.createDataFrame([(i, o, p) for i, (o, p) in enumerate(rows)], "detail_id bigint, order_id bigint, product_id bigint")


def _first(df, k):
    order = [F.col("co_count").desc(), "product_a", "product_b"]
    return [tuple(r) for r in df.orderBy(*order).limit(k).collect()]


def _zipf_rows(seed, orders, products):
    rng = random.Random(seed)
    weights = [1 / (i + 1) ** 1.3 for i in range(products)]
    rows = [(o, p) for o in range(orders) for p in rng.choices(range(products), weights, k=rng.randint(1, 6))]
    return rows


def test_top_pairs_on_skewed_products_counts_fewer_pairs(spark):
    d = _lines(spark, _zipf_rows(1, 3000, 2000))
    full = baskets.co_purchase(d)
    for k in (1, 10, 25):
        trace = []
        assert _first(baskets.top_pairs(d, k, seed_products=20, trace=trace), k) == _first(full, k)
        assert trace[-1]["products"] < 500                     # of 2,000
    items = baskets._weighted_items(d, False)
    kept = baskets.pair_bounds(items).orderBy(F.col("bound").desc()).limit(trace[-1]["products"])
    assert baskets._count_pairs(items.join(kept, "product_id"), None).count() < full.count() / 3


@pytest.mark.parametrize("distinct", [False, True])
def test_top_pairs_with_ties_and_a_hot_order(spark, distinct):
    rng = random.Random(2)
    rows = [(0, p) for p in range(300)] + [(0, 7), (0, 7), (0, 9)]                    # one order with a third of all lines
    rows += [(rng.randint(1, 150), rng.randint(0, 40)) for _ in range(600)] + [(1, None), (None, 3), (None, 4)]
    d = _lines(spark, rows)
    full = baskets.co_purchase(d, distinct, split_above=16)
    for k, seeds, growth in ((1, 2, 2), (10, 3, 2), (50, 1000, 8), (200, 5, 3)):
        got = baskets.top_pairs(d, k, distinct, seed_products=seeds, growth=growth, split_above=16)
        assert _first(got, k) == _first(full, k)


def test_top_pairs_on_small_tables(spark):
    assert baskets.top_pairs(_lines(spark, []), 5).collect() == []
    assert baskets.top_pairs(_lines(spark, [(1, 1), (1, 1), (2, 3)]), 5).collect() == []
    assert _first(baskets.top_pairs(_lines(spark, [(1, 2), (1, 1), (2, 3)]), 5), 5) == [(1, 2, 1)]


def test_pair_bounds_hold(spark):
    d = _lines(spark, _zipf_rows(3, 400, 60))
    bound = {r.product_id: r.bound for r in baskets.pair_bounds(baskets._weighted_items(d, False)).collect()}
    for r in baskets.co_purchase(d).collect():
        assert r.co_count <= min(bound[r.product_a], bound[r.product_b])


class _Model:
    """Factors as a fitted model holds them."""

    def __init__(self, spark, users, items):
        self.userFactors, self.itemFactors = (spark.createDataFrame(
            [(i, [float(x) for x in f]) for i, f in rows], "id int, features array<float>") for rows in (users, items))


@pytest.mark.parametrize("item_block,user_block,copies", [(20_000, 4096, 4), (7, 5, 3), (1, 1, 1), (13, 100, 2)])
def test_norm_bounded_top_k_equals_the_full_product(spark, item_block, user_block, copies):
    rng = np.random.default_rng(5)
    u = rng.normal(size=(40, 3)).astype(np.float32)
    v = (rng.normal(size=(90, 3)) * rng.pareto(1.5, size=(90, 1))).astype(np.float32)
    v[10:20] = v[0]                                               # equal scores
    u[3] = 0
    model = _Model(spark, list(enumerate(u)), [(1000 - i, f) for i, f in enumerate(v)])
    want = set()
    for i in range(len(u)):
        s = np.zeros(len(v))
        for f in range(3):
            s += u[i, f].astype(np.float64) * v[:, f].astype(np.float64)
        want |= {(i, 1000 - j) for j in sorted(range(len(v)), key=lambda j: (-s[j], 1000 - j))[:4]}
    got = ml.recommend(model, 4, item_block, user_block, copies).collect()
    assert len(got) == 160 and {(r.user_id_idx, r.product_id_idx) for r in got} == want


def test_norm_bounds_spare_blocks(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(400, 3)).astype(np.float32) * np.linspace(100, 0.01, 400)[:, None].astype(np.float32)
    u = np.abs(rng.normal(size=(30, 3))).astype(np.float32)
    headers = [(b, float(np.linalg.norm(v[b * 20:(b + 1) * 20], axis=1).max())) for b in range(1, 20)]
    import pandas as pd
    first = np.sort(u.astype(np.float64) @ v[:20].T.astype(np.float64), axis=1)[:, -3]
    row = pd.DataFrame({"block": [0], "ids": [list(range(30))], "factors": [u.tobytes()], "known": [list(range(30))],
                        "scores": [first.tolist()]})
    need = next(ml._needed_blocks(headers, 3)([row]))["item_block"].tolist()
    assert need == sorted(need) and len(need) < 19
    rest = np.setdiff1d(np.arange(1, 20), need)
    assert all((u.astype(np.float64) @ v[b * 20:(b + 1) * 20].T <= first[:, None]).all() for b in rest)


def test_fewer_items_than_k_and_no_items(spark):
    model = _Model(spark, [(0, [1, 0]), (1, [0, 1])], [(5, [1, 2]), (6, [3, 1])])
    assert sorted((r.user_id_idx, r.product_id_idx, r.score) for r in ml.recommend(model, 5).collect()) == [
        (0, 5, 1.0), (0, 6, 3.0), (1, 5, 2.0), (1, 6, 1.0)]
    assert ml.recommend(_Model(spark, [(0, [1, 0])], []), 5).collect() == []


def test_fit_checks_notice_wrong_results(spark):
    r = ml.ratings(B.fact_order_detail(spark, SF_SMALL), B.fact_order(spark, SF_SMALL))
    data = ml.rating_data(r)
    model = ml.als_fit(None, data=data)
    train = data.ratings.where("is_train")
    assert ml.als_stationarity(model, train).agg(F.max("violation")).first()[0] <= 0.02
    moved = train.withColumn("rating", F.col("rating") + F.col("user_id_idx") % 3)
    assert ml.als_stationarity(model, moved).agg(F.max("violation")).first()[0] > 0.1


def test_point_silhouettes_equal_the_definition(spark):
    rng = np.random.default_rng(7)
    pts = [(int(c), [float(x) for x in rng.normal(size=3) + c]) for c in [0] * 8 + [1] * 6 + [2]]
    df = spark.createDataFrame(pts, "cluster int, v array<double>")
    got = {tuple(r.v): r.silhouette for r in ml.point_silhouettes(df).collect()}
    for i, (c, v) in enumerate(pts):
        d = {k: [sum((a - b) ** 2 for a, b in zip(v, w)) for j, (e, w) in enumerate(pts) if e == k and j != i] for k in (0, 1, 2)}
        if not d[c]:
            assert got[tuple(v)] == 0
            continue
        a, b = np.mean(d[c]), min(np.mean(d[k]) for k in d if k != c)
        assert abs(got[tuple(v)] - (b - a) / max(a, b)) < 1e-9
    dwd = clean.dwd_order(B.fact_order(spark, SF_SMALL))
    assert ml.cluster_checked(dwd).collect()[0].nearest
