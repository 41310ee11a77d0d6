"""Task sizes, block counts and scored items where tables grow."""

import numpy as np
import pandas as pd

from shoplake.operators import baskets, ml


def test_co_purchase_partitions_follow_lines_and_pairs(spark, monkeypatch):
    lines = [(i, o, (7 * o + 3 * i) % 400) for i, o in enumerate(o for o in range(500) for _ in range(o % 7 + 1))]
    d = spark.createDataFrame(lines + [(0, None, 5), (0, 3, None)], "detail_id bigint, order_id bigint, product_id bigint")
    plain = sorted(tuple(r) for r in baskets.co_purchase(d, split_above=None).collect())
    monkeypatch.setattr(baskets, "LINES_PER_PART", 50, raising=False)
    monkeypatch.setattr(baskets, "PAIRS_PER_PART", 100, raising=False)
    for split in (4, 2048):
        got = baskets.co_purchase(d, split_above=split)
        assert got.rdd.getNumPartitions() >= len(lines) // 50                  # 8 shuffle partitions in this session
        assert sorted(tuple(r) for r in got.collect()) == plain


def test_a_few_million_ratings_share_a_factor_block():
    # a user's factors travel to every block that holds one of its ratings: few ratings a block made copies grow with the table
    assert ml.parts_for(24_000_000, ml.RATINGS_PER_BLOCK) == 8
    assert ml.parts_for(144_000_000, ml.RATINGS_PER_BLOCK) < 40


def test_best_of_block_scores_items_only_while_they_can_count():
    rng = np.random.default_rng(5)
    n, m, k = 300, 5000, 5
    u = rng.random((n, 4)).astype("<f4")
    v = (rng.random((m, 4)) * np.linspace(3, 0.1, m)[:, None]).astype("<f4")
    v = v[np.argsort(-np.linalg.norm(v.astype(float), axis=1), kind="stable")]
    v[10:20] = v[10]                                                        # ties, cut by item number
    items = rng.permutation(m).astype(np.int32)
    users = np.arange(n, dtype=np.int32) * 3
    scores = sum(u.astype(float)[:, f, None] * v.astype(float)[None, :, f] for f in range(4))
    want = {(int(users[i]), int(items[j]), float(scores[i, j]))
            for i in range(n) for j in np.lexsort((items, -scores[i]))[:k]}
    row = {"ids": users, "factors": u.tobytes(), "least": None, "item_ids": items, "item_factors": v.tobytes()}
    for some_items, some_users in ((256, 1024), (3, 7), (10_000, 50)):
        got = pd.concat(ml._best_of_block(k, some_items, some_users)([pd.DataFrame([row])]))
        assert {tuple(r) for r in got.itertuples(index=False)} == want
    least = np.sort(scores, axis=1)[:, -3].astype("<f8")                        # only the best three reach it
    got = pd.concat(ml._best_of_block(k)([pd.DataFrame([dict(row, least=least.tobytes())])]))
    assert {tuple(r) for r in got.itertuples(index=False)} == {t for t in want if t[2] >= least[t[0] // 3]}
    few = pd.concat(ml._best_of_block(k)([pd.DataFrame([dict(row, item_ids=items[:3], item_factors=v[:3].tobytes())])]))
    assert len(few) == 3 * n
