"""Recommendation (ALS) and customer clustering (K-Means) on MLlib.

Feature building is ordinary DataFrame work; fitting is an action by nature,
so these functions (unlike the rest of the library) run Spark jobs.  Inputs
to iterative fits are persisted for the duration of the fit and released
afterwards; ALS cuts its lineage with checkpoints in the session's
checkpoint folder.

The train/test split is a hash of (user, product), not ``randomSplit``:
``randomSplit`` depends on how rows are partitioned, so a re-run on a
different cluster layout would give a different split.  ALS blocks and the
K-Means layout follow the number of rows, not the cluster, rows are sorted within partitions, and clusters are
numbered by their centres: results do not depend on the cluster's size, up
to the last bits of floating-point sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplake.functions.columns import money_avg
from shoplake.functions.labels import ALS_PARAMS, ALS_TOP_K, KMEANS_K, KMEANS_SEED, VALID_STATUSES
from shoplake.plans.joins import dim_join
from shoplake.session import parts_for, stored_table

FEATURES = ("order_cnt", "total_spent", "avg_order_value")


@contextmanager
def persisted(*dfs: DataFrame, level=StorageLevel.MEMORY_AND_DISK):
    """K6: persist for the body of a ``with`` block, always unpersist after."""
    for df in dfs:
        df.persist(level)
    try:
        yield dfs
    finally:
        for df in dfs:
            df.unpersist()


def ratings(details: DataFrame, orders: DataFrame,
            statuses: Sequence[str] = VALID_STATUSES) -> DataFrame:
    """J3 + A23 + P2: purchase count per (user, product) over orders in ``statuses``."""
    paid = orders.where(F.col("order_status").isin(*statuses)).select("order_id", "user_id")
    return (details.join(paid, "order_id", "inner")
            .where(F.col("user_id").isNotNull())
            .groupBy("user_id", "product_id")
            .agg(F.count("detail_id").alias("purchase_count"))
            .withColumn("rating", F.col("purchase_count").cast("double")))


def rating_stats(r: DataFrame) -> DataFrame:
    """Pairs, distinct users and distinct products of the rating matrix."""
    return r.agg(F.count(F.lit(1)).alias("pairs"),
                 F.count_distinct("user_id").alias("users"),
                 F.count_distinct("product_id").alias("products"))


def train_flag(cols: Sequence[str], train_pct: int = 80, seed: int = 42):
    """True for about ``train_pct`` percent of rows, chosen by an MD5 of ``cols`` (the same in any SQL engine)."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100 < train_pct


def hash_split(df: DataFrame, cols: Sequence[str], train_pct: int = 80, seed: int = 42):
    """M1: deterministic train/test split by a hash of ``cols``."""
    flag = train_flag(cols, train_pct, seed)
    return df.where(flag), df.where(~flag)


ID_BUCKETS = 1024
RATINGS_PER_BLOCK = 5_000_000
ITEM_BLOCK = 20_000
SOME_ITEMS = 256
SOME_USERS = 1024
USER_BLOCK = 4096
COPIES = 32
USERS_PER_PARTITION = 200_000


def dense_ids(df: DataFrame, col: str, buckets: int = ID_BUCKETS) -> DataFrame:
    """``(col, <col>_idx)``: the distinct values numbered 0, 1, ... as INT, whatever their own type.

    Values are ranked within hash buckets and offset by the sizes of the
    buckets before, a table of ``buckets`` rows: no task sees all values, and
    a value's number follows from the values alone.
    """
    ids = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn(
        "_b", F.pmod(F.xxhash64(col), F.lit(buckets)))
    sizes = ids.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    ranked = ids.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(col)) - 1)
    # at most ``buckets`` rows
    return ranked.join(F.broadcast(offsets), "_b").select(
        col, (F.col("_off") + F.col("_r")).cast("int").alias(f"{col}_idx"))


def split_ratings(r: DataFrame, train_pct: int = 80) -> DataFrame:
    """M1: the rating pairs with ``is_train``."""
    return r.select("user_id", "product_id", train_flag(["user_id", "product_id"], train_pct).alias("is_train"))


@dataclass
class RatingData:
    """Ratings with dense INT ids (ALS takes INT ids only, the business keys are BIGINT) and the two id tables, all stored."""
    ratings: DataFrame
    users: DataFrame
    items: DataFrame
    rows: int


def rating_data(r: DataFrame, train_pct: int = 80) -> RatingData:
    """Read the ratings once, number users and products once; every later step uses these tables."""
    r = stored_table(r.select("user_id", "product_id", "rating"), "ratings")
    users, items = (stored_table(dense_ids(r, c), f"ids-{c}") for c in ("user_id", "product_id"))
    numbered = (r.join(users, "user_id").join(items, "product_id")
                .withColumn("is_train", train_flag(["user_id", "product_id"], train_pct))
                .select("user_id", "product_id", "user_id_idx", "product_id_idx", "rating", "is_train"))
    return RatingData(stored_table(numbered, "ratings-numbered"), users, items, r.count())


def als_estimator(implicit: bool = False, blocks: int = 10, **params):
    """ALS with the reference parameters and a given number of user and item blocks."""
    from pyspark.ml.recommendation import ALS
    p = dict(ALS_PARAMS, numUserBlocks=blocks, numItemBlocks=blocks)
    p.update(params)
    return ALS(userCol="user_id_idx", itemCol="product_id_idx", ratingCol="rating",
               implicitPrefs=implicit, coldStartStrategy="drop", **p)


def als_fit(r: DataFrame | None, implicit: bool = False, train_pct: int = 80, data: RatingData | None = None, **params):
    """M2: fit on the train split only (no counts, no evaluation)."""
    data = data or rating_data(r, train_pct)
    train = data.ratings.where("is_train")
    with persisted(train):
        return als_estimator(implicit, parts_for(data.rows, RATINGS_PER_BLOCK), **params).fit(train)


def als_fit_evaluate(r: DataFrame | None, implicit: bool = False, train_pct: int = 80, data: RatingData | None = None,
                     **params):
    """M2 + M3: fit on the train split, RMSE on the test split.

    Returns ``(model, train_rows, test_rows, rmse)``.
    """
    from pyspark.ml.evaluation import RegressionEvaluator
    data = data or rating_data(r, train_pct)
    counts = data.ratings.agg(F.count_if("is_train").alias("tr"), F.count_if(~F.col("is_train")).alias("te")).first()
    model = als_fit(None, implicit, train_pct, data, **params)
    pred = model.transform(data.ratings.where(~F.col("is_train")))
    rmse = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(pred)
    return model, counts["tr"], counts["te"], rmse


def als_rmse(spark: SparkSession, r: DataFrame, implicit: bool = False, **params) -> DataFrame:
    """One row: train_rows, test_rows, rmse."""
    _, n_train, n_test, rmse = als_fit_evaluate(r, implicit, **params)
    return spark.createDataFrame([(n_train, n_test, float(rmse))],
                                 "train_rows bigint, test_rows bigint, rmse double")


def _factor_blocks(block: int):
    """Arrow batches (id, features, norm) -> rows of up to ``block`` factors: key, greatest norm, ids, factors."""
    def run(batches):
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext
        key = TaskContext.get().partitionId() << 32
        held: list = []

        def out(pdf):
            nonlocal key
            key += 1
            return pd.DataFrame({
                "block": [key], "norm": [float(pdf["norm"].max())], "n": [len(pdf)],
                "ids": [pdf["id"].to_numpy()],
                "factors": [np.array(pdf["features"].tolist(), dtype="<f4").tobytes()]})
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= block:
                now = pd.concat(held)
                while len(now) >= block:
                    yield out(now.iloc[:block])
                    now = now.iloc[block:]
                held = [now] if len(now) else []
        if held:
            yield out(pd.concat(held))
    return run


BLOCK_ROWS = "block bigint, norm double, n int, ids array<int>, factors binary"
BEST_ROWS = "user_id_idx int, product_id_idx int, score double"
SLACK = 1 + 1e-9


def factor_blocks(factors: DataFrame, block: int, by_norm: bool, name: str) -> DataFrame:
    """Factors as stored rows of up to ``block`` vectors; ``by_norm``: in ranges of falling norm."""
    rows = factors.select("id", "features", F.sqrt(F.aggregate(
        "features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm"))
    if by_norm:
        rows = rows.repartitionByRange(F.col("norm").desc(), F.col("id")).sortWithinPartitions(F.col("norm").desc(), "id")
    return stored_table(rows.mapInPandas(_factor_blocks(block), BLOCK_ROWS), name)


def _unpacked(ids, factors: bytes):
    import numpy as np
    ids = np.asarray(ids, dtype=np.int32)
    return ids, np.frombuffer(factors, "<f4").reshape(len(ids), -1).astype(np.float64)


def _best_of_block(k: int, some_items: int = SOME_ITEMS, some_users: int = SOME_USERS):
    """Rows (ids, factors, least, item_ids, item_factors) -> the k best items of the block per user, those that reach ``least``.

    Items come in order of falling norm and are scored in slices; a user is done
    when the product of norms shows that no later slice can reach the k-th score found.
    Scores are sums over the rank in a fixed order, so they do not depend on
    the blocks; equal scores go by item number.
    """
    def best(users, u, least, items, v):
        import numpy as np
        import pandas as pd
        size, norms = (np.sqrt((x * x).sum(axis=1)) for x in (u, v))
        greatest = np.maximum.accumulate(norms[::-1])[::-1]                # of an item and all after it
        low, top = least.copy(), np.full((len(u), k), -np.inf)
        found, alive = [], np.arange(len(u))
        for at in range(0, len(items), some_items):
            alive = alive[size[alive] * greatest[at] * SLACK >= low[alive]]
            if not len(alive):
                break
            part, some = u[alive], v[at:at + some_items]
            scores = part[:, 0, None] * some[None, :, 0]
            for f in range(1, u.shape[1]):
                scores += part[:, f, None] * some[None, :, f]
            seen = np.concatenate([top[alive], scores], axis=1)
            top[alive] = np.partition(seen, seen.shape[1] - k, axis=1)[:, -k:]
            low[alive] = np.maximum(low[alive], top[alive].min(axis=1))
            who, what = np.nonzero(scores >= low[alive][:, None])
            found.append((alive[who], at + what, scores[who, what]))
        who, what, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        keep = score >= low[who]
        who, what, score = who[keep], what[keep], score[keep]
        order = np.lexsort((items[what], -score, who))
        who, what, score = who[order], what[order], score[order]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < k
        return pd.DataFrame({"user_id_idx": users[who[keep]], "product_id_idx": items[what[keep]], "score": score[keep]})

    def run(batches):
        import numpy as np
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                users, u = _unpacked(row.ids, row.factors)
                items, v = _unpacked(row.item_ids, row.item_factors)
                least = np.frombuffer(row.least, "<f8") if row.least is not None else np.full(len(users), -np.inf)
                for at in range(0, len(users), some_users):
                    part = slice(at, at + some_users)
                    yield best(users[part], u[part], least[part], items, v)
    return run


def _needed_blocks(headers: list, k: int):
    """Rows (block, ids, factors, known, scores) of users -> (block, item_block, least) that may still count."""
    def run(batches):
        import numpy as np
        import pandas as pd
        names, norms = [h[0] for h in headers], np.array([h[1] for h in headers])
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                users, u = _unpacked(row.ids, row.factors)
                best = {} if row.known is None else dict(zip(np.asarray(row.known).tolist(), row.scores))
                least = np.array([best.get(x, -np.inf) for x in users.tolist()], dtype="<f8")
                # |user| x |item| bounds the score; a block is needed if some user's threshold lies at or below its bound
                size = np.sqrt((u * u).sum(axis=1))
                reach = (size[:, None] * norms[None, :] * SLACK >= least[:, None]).any(axis=0)
                rows += [(row.block, names[j], least.tobytes()) for j in np.flatnonzero(reach)]
            yield pd.DataFrame(rows, columns=["block", "item_block", "least"])
    return run


def _scored(pairs: DataFrame, users: DataFrame, items: DataFrame, k: int, copies: int) -> DataFrame:
    """(block, item_block, least) pairs -> the k best items of each pair; every item block travels in ``copies`` copies."""
    salt = F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int")
    spread = items.select(F.col("block").alias("item_block"), F.col("ids").alias("item_ids"), F.col("factors").alias("item_factors"),
                          F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("salt"))
    met = (pairs.join(users.select("block", "ids", "factors"), "block").withColumn("salt", salt)
           .join(spread, ["item_block", "salt"]))
    return met.select("ids", "factors", "least", "item_ids", "item_factors").mapInPandas(_best_of_block(k), BEST_ROWS)


def _k_best(rows: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("user_id_idx").orderBy(F.col("score").desc(), "product_id_idx")
    return rows.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")


def recommend(model, k: int, item_block: int = ITEM_BLOCK, user_block: int = USER_BLOCK, copies: int = COPIES) -> DataFrame:
    """M4: (user_id_idx, product_id_idx, score), the k best items of every user of the model; exact.

    Items are held on Spark as blocks in order of falling norm.  All users meet
    the first block and get a threshold, their k-th score.  A user's score with
    an item is at most the product of their norms, so a later block is scored
    only for groups of users of whom one may still gain from it.  Only k rows
    per user and scored block leave a task, and a final ranking keeps k of these.
    The driver sees one (block, norm) pair per ``item_block`` items, and no factors.
    """
    items = factor_blocks(model.itemFactors, item_block, True, "item-blocks")
    users = factor_blocks(model.userFactors, user_block, False, "user-blocks")
    headers = [(h["block"], h["norm"]) for h in items.select("block", "norm").orderBy(F.col("norm").desc(), "block").collect()]
    if not headers:
        return items.sparkSession.createDataFrame([], BEST_ROWS)
    nothing = F.lit(None).cast("binary").alias("least")
    first = users.select("block", F.lit(headers[0][0]).alias("item_block"), nothing)
    found = _scored(first, users, items.where(F.col("block") == headers[0][0]), k, copies)
    if len(headers) == 1:
        return found
    found = stored_table(found, "first-best")
    place = users.select("block", F.explode("ids").alias("user_id_idx"))
    least = (found.groupBy("user_id_idx").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
             .join(place, "user_id_idx").groupBy("block")
             .agg(F.collect_list(F.struct("user_id_idx", "least")).alias("best"))                       # at most user_block
             .select("block", F.col("best.user_id_idx").alias("known"), F.col("best.least").alias("scores")))
    pairs = stored_table(users.select("block", "ids", "factors").join(least, "block", "left").mapInPandas(
        _needed_blocks(headers[1:], k), "block bigint, item_block bigint, least binary"), "block-pairs")
    return _k_best(found.unionByName(_scored(pairs, users, items, k, copies)), k)


def als_top_k(r: DataFrame | None, products: DataFrame, k: int = ALS_TOP_K, implicit: bool = False,
              model=None, data: RatingData | None = None, **params) -> DataFrame:
    """M4 + M5 + J6: top-k products per rated user with names and rounded scores.

    Every user with a rating in the training split gets k products (users
    seen only in the test split are cold starts and get none, as with the
    reference's subset call over all rated users).
    """
    data = data or rating_data(r)
    if model is None:
        model = als_fit(None, implicit, data=data, **params)
    recs = (recommend(model, k).join(data.users, "user_id_idx").join(data.items, "product_id_idx")
            .select("user_id", "product_id", F.round("score", 4).alias("score")))
    names = products.select("product_id", "product_name", "category")
    return dim_join(recs, names, "product_id").select(
        "user_id", "product_id", "product_name", "category", "score")


def top_k_contract(recs: DataFrame, r: DataFrame) -> DataFrame:
    """One row of facts any top-k must meet: users, rows per user, pairs named twice, products without a rating."""
    known = r.select("product_id").distinct().withColumn("known", F.lit(1))
    per_user = recs.join(known, "product_id", "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("d"), F.count_if(F.col("known").isNull()).alias("u"))
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
                        F.sum(F.col("n") - F.col("d")).alias("repeated"), F.sum("u").alias("unknown_products"))


def _dot(x: str, y: str):
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, v: a + v)


def als_stationarity(model, train: DataFrame, reg: float = ALS_PARAMS["regParam"]) -> DataFrame:
    """M2 checked: (user_id_idx, n, violation), how far each user's factors are from solving their normal equations.

    The last half-step of ALS solves, per user with n ratings, for x with
    non-negative entries: gradient g = sum((x . y - rating) y) + reg n x is zero
    where x is positive and not negative elsewhere.  ``violation`` is the largest
    breach, relative to the size of sum(rating |y|) + reg n |x|.
    """
    u = model.userFactors.select(F.col("id").alias("user_id_idx"), F.col("features").alias("x"))
    v = model.itemFactors.select(F.col("id").alias("product_id_idx"), F.col("features").alias("y"))
    rank = model.rank
    # items first: rows then travel to their users once, and the sums per user need no further shuffle
    rated = train.join(v, "product_id_idx").select("user_id_idx", "rating", "y")
    rows = rated.join(u, "user_id_idx").withColumn("gap", _dot("x", "y") - F.col("rating"))
    sums = rows.groupBy("user_id_idx").agg(
        F.count(F.lit(1)).alias("n"), F.first("x").alias("x"),
        F.array(*[F.sum(F.col("gap") * F.col("y")[j]) for j in range(rank)]).alias("g"),
        F.sum(F.col("rating") * F.sqrt(_dot("y", "y"))).alias("scale"))
    breach = [F.when(F.col("x")[j] > 1e-4, F.abs(F.col("g")[j] + reg * F.col("n") * F.col("x")[j]))
              .otherwise(F.greatest(F.lit(0.0), -(F.col("g")[j] + reg * F.col("n") * F.col("x")[j]))) for j in range(rank)]
    return sums.select("user_id_idx", "n", (F.greatest(*breach) / (
        F.col("scale") + reg * F.col("n") * F.sqrt(_dot("x", "x")) + 1e-9)).alias("violation"))


def als_checked(r: DataFrame, k: int = ALS_TOP_K, tolerance: float = 0.02, **params) -> DataFrame:
    """M2-M4 checked from one fit: split sizes, and whether factors, RMSE and top-k scores are what they should be.

    ``stationary``: every user's factors solve their normal equations within
    ``tolerance`` (MLlib's non-negative solver stops early; factors are 32-bit).  ``rmse_agrees``: the error
    computed by joining the stored factors equals the evaluator's.
    ``scores_agree``: every recommended score equals the product of the stored factors.
    """
    data = rating_data(r)
    model, n_train, n_test, rmse = als_fit_evaluate(None, data=data, **params)
    u = model.userFactors.select(F.col("id").alias("user_id_idx"), F.col("features").alias("x"))
    v = model.itemFactors.select(F.col("id").alias("product_id_idx"), F.col("features").alias("y"))
    worst = als_stationarity(model, data.ratings.where("is_train")).agg(F.max("violation")).first()[0]
    own = (data.ratings.where(~F.col("is_train")).join(u, "user_id_idx").join(v, "product_id_idx")
           .agg(F.sqrt(F.avg(F.pow(_dot("x", "y") - F.col("rating"), F.lit(2))))).first()[0])
    wrong = (recommend(model, k).join(u, "user_id_idx").join(v, "product_id_idx")
             .where(F.abs(_dot("x", "y") - F.col("score")) > 1e-9 * (1 + F.abs("score"))).count())
    return r.sparkSession.createDataFrame(
        [(n_train, n_test, worst is not None and worst <= tolerance, abs((own or 0) - rmse) <= 1e-4 * (1 + rmse), wrong == 0)],
        "train_rows bigint, test_rows bigint, stationary boolean, rmse_agrees boolean, scores_agree boolean")


def user_features(dwd: DataFrame | None, facts: DataFrame | None = None) -> DataFrame:
    """Order count, spend and mean order value per user."""
    from shoplake.operators.users import user_spending
    return user_spending(dwd, facts).select(
        "user_id", "order_cnt", "total_spent", F.col("avg_per_order").alias("avg_order_value"))


def cluster_pipeline(k: int = KMEANS_K, seed: int = KMEANS_SEED):
    """M6 + M7 + M8 (M11): assemble -> standardise -> K-Means."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
    ])


def fit_clusters(features: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED,
                 partitions: int | None = None):
    """Fit on a layout that follows the number of users; returns ``(pipeline_model, order, clustered_frame)``.

    ``order`` lists the fitted centre numbers by centre, least first; the
    column ``cluster`` holds the position in that list, so numbers do not
    depend on the order in which the fit found the clusters.
    """
    features = stored_table(features, "cluster-features")
    partitions = partitions or parts_for(features.count(), USERS_PER_PARTITION)
    laid = features.repartition(partitions, "user_id").sortWithinPartitions("user_id")
    with persisted(laid):
        model = cluster_pipeline(k, seed).fit(laid)
    centres = model.stages[-1].clusterCenters()                 # k small vectors
    order = sorted(range(len(centres)), key=lambda i: tuple(round(float(x), 6) for x in centres[i]))
    number = F.array(*[F.lit(order.index(i)) for i in range(len(centres))])
    clustered = model.transform(laid).withColumn("cluster", F.get(number, F.col("cluster")).cast("int"))
    return model, order, clustered


def cluster_results(dwd: DataFrame | None, k: int = KMEANS_K, seed: int = KMEANS_SEED,
                    facts: DataFrame | None = None) -> dict[str, DataFrame]:
    """M8-M10 + A25 from one fit: ``user_clusters``, ``cluster_summary``, ``cluster_quality``."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    features = user_features(dwd, facts)
    spark = features.sparkSession
    model, order, clustered = fit_clusters(features, k, seed)
    silhouette = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                                     metricName="silhouette").evaluate(clustered)
    centres = model.stages[-1].clusterCenters()
    rows = [(i, *[round(float(x), 6) for x in centres[c]], round(float(silhouette), 6)) for i, c in enumerate(order)]
    users = clustered.select("user_id", "cluster", *FEATURES)
    return {
        "user_clusters": users,
        "cluster_summary": cluster_summary(users),
        "cluster_quality": spark.createDataFrame(rows, "cluster int, centre_order_cnt double, "
                                                       "centre_total_spent double, centre_aov double, "
                                                       "silhouette double"),
    }


def point_silhouettes(points: DataFrame) -> DataFrame:
    """M10 in closed form: (cluster, v array) rows -> with ``silhouette`` per row, squared Euclidean distance.

    The mean squared distance of a point x to a cluster of n points with sum s
    and sum of squared norms q is |x|^2 - 2 x.s/n + q/n, so one row of sums per
    cluster is all that travels.  In its own cluster the point itself does not
    count; a point alone in its cluster has silhouette 0.
    """
    dims = len(FEATURES)
    sums = points.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v")[j]) for j in range(dims)]).alias("s"), F.sum(_dot("v", "v")).alias("q"))
    every = sums.agg(F.collect_list(F.struct("cluster", "n", "s", "q")).alias("all"))          # k clusters
    size = _dot("v", "v")

    def distance(c):
        return size - 2 * F.aggregate(F.zip_with(F.col("v"), c["s"], lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x) / c["n"] + c["q"] / c["n"]
    met = points.withColumn("one", F.lit(1)).join(F.broadcast(every.withColumn("one", F.lit(1))), "one").drop("one")
    own = F.filter("all", lambda c: c["cluster"] == F.col("cluster"))[0]
    a = distance(own) * own["n"] / F.greatest(own["n"] - 1, F.lit(1))
    b = F.array_min(F.transform(F.filter("all", lambda c: c["cluster"] != F.col("cluster")), distance))
    return met.withColumn("silhouette", F.when((own["n"] == 1) | b.isNull(), F.lit(0.0)).otherwise(
        (b - a) / F.greatest(a, b, F.lit(1e-300)))).drop("all")


def cluster_checked(dwd: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED) -> DataFrame:
    """M8-M10 checked from one fit: users, whether each sits at its nearest centre, and whether the silhouette agrees."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import vector_to_array
    model, order, clustered = fit_clusters(user_features(dwd), k, seed)
    centres = [model.stages[-1].clusterCenters()[c] for c in order]
    points = clustered.select("cluster", vector_to_array("features").alias("v"))

    def to_centre(c):
        return sum((F.col("v")[j] - float(c[j])) * (F.col("v")[j] - float(c[j])) for j in range(len(FEATURES)))
    distances = F.array(*[to_centre(c) for c in centres])
    facts = point_silhouettes(points).agg(
        F.count(F.lit(1)).alias("users"),
        F.max(F.get(distances, F.col("cluster")) - F.array_min(distances)).alias("farther"),
        F.avg("silhouette").alias("silhouette")).first()
    theirs = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette").evaluate(clustered)
    return dwd.sparkSession.createDataFrame(
        [(facts["users"], len(order), facts["farther"] <= 1e-9, abs(facts["silhouette"] - theirs) <= 1e-6)],
        "users bigint, clusters int, nearest boolean, silhouette_agrees boolean")


def user_clusters(dwd: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED) -> DataFrame:
    """Cluster number per user with the three raw features."""
    return fit_clusters(user_features(dwd), k, seed)[2].select("user_id", "cluster", *FEATURES)


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Users and mean features per cluster (input: ``user_clusters``)."""
    return clusters.groupBy("cluster").agg(
        F.count("user_id").alias("user_cnt"),
        F.round(F.avg("order_cnt"), 1).alias("avg_orders"),
        money_avg("total_spent").alias("avg_spent"),
        money_avg("avg_order_value").alias("avg_aov"))


def cluster_quality(dwd: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED) -> DataFrame:
    """M9 + M10: scaled cluster centres and the silhouette (one row per cluster)."""
    return cluster_results(dwd, k, seed)["cluster_quality"]


def scaled_features(features: DataFrame, scale: int = 4) -> DataFrame:
    """M6 + M7: the standardised features per user, rounded."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    stages = cluster_pipeline().getStages()[:2]
    v = vector_to_array("features")
    return Pipeline(stages=stages).fit(features).transform(features).select(
        "user_id", *[F.round(v[i], scale).alias(f"{c}_scaled") for i, c in enumerate(FEATURES)])


def sample_recommendations(recs: DataFrame, n_users: int = 3) -> DataFrame:
    """T5 + J7: all recommendations of the ``n_users`` smallest user ids.

    The reference takes an unordered ``limit`` of distinct users; ordering
    the ids makes the sample deterministic.  The n-row id list is the
    broadcast side of a semi join (bounded by ``n_users``).
    """
    ids = recs.select("user_id").distinct().orderBy("user_id").limit(n_users)
    return recs.join(F.broadcast(ids), "user_id", "left_semi")
