"""ML structure checks, plan-shape checks and the job runner."""

import os
import pathlib
import re
import sys
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplake.operators import baskets, clean, ml, products
from shoplake.plans import jobs
from shoplake.sources import bindings as B

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_als_structure(spark):
    r = ml.ratings(B.fact_order_detail(spark, SF_SMALL), B.fact_order(spark, SF_SMALL))
    model, n_train, n_test, rmse = ml.als_fit_evaluate(r)
    assert n_train > n_test > 0 and rmse == rmse and rmse >= 0
    recs = ml.als_top_k(r, B.dim_product(spark, SF_SMALL), 5, model=model)
    per_user = recs.groupBy("user_id").agg(F.count("*").alias("n"),
                                           F.collect_list("score").alias("s"))
    assert per_user.where("n != 5").count() == 0
    # hash split is stable
    a, _ = ml.hash_split(r, ["user_id", "product_id"])
    b, _ = ml.hash_split(r.repartition(3), ["user_id", "product_id"])
    assert a.count() == b.count()


def test_clusters_structure(spark):
    dwd = clean.dwd_order(B.fact_order(spark, SF_SMALL))
    cl = ml.user_clusters(dwd)
    summary = ml.cluster_summary(cl).collect()
    assert len(summary) == 4 and all(r.user_cnt > 0 for r in summary)
    assert sum(r.user_cnt for r in summary) == ml.user_features(dwd).count()
    q = ml.cluster_quality(dwd).collect()
    assert len(q) == 4 and -1 <= q[0].silhouette <= 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_group_limit_in_brand_top3(spark):
    df = E.queries()["brand_top3"](spark, SF_SMALL)
    assert "WindowGroupLimit" in df._jdf.queryExecution().sparkPlan().toString()


def test_filters_and_pruning_reach_the_scan(spark):
    root = tempfile.mkdtemp(prefix="shoplake-plan-")
    o = B.fact_order(spark, SF_SMALL).select(
        "order_id", "user_id", "order_status", "order_amount", "discount_amount",
        "actual_amount", "payment_method", "order_time")
    o.write.parquet(f"{root}/o")
    plan = _plan(clean.dwd_order(spark.read.parquet(f"{root}/o")))
    assert re.search(r"PushedFilters: \[[^\]]*In\(order_status", plan)
    as_double = spark.read.parquet(f"{root}/o").withColumn("actual_amount", F.col("actual_amount").cast("double"))
    as_double.write.parquet(f"{root}/d")
    plan = _plan(clean.dwd_order(spark.read.parquet(f"{root}/d")))
    assert re.search(r"PushedFilters: .*GreaterThan\(actual_amount", plan)
    daily = E.queries()["daily_trade"](spark, SF_SMALL)
    scan = [ln for ln in _plan(daily).splitlines() if "ReadSchema" in ln][0]
    assert "o_orderpriority" not in scan  # payment method not needed for the daily summary


def test_top_pairs_broadcast_is_the_k_row_side(spark):
    df = baskets.top_co_purchase(None, B.dim_product(spark, SF_SMALL), 10,
                                 pairs=baskets.co_purchase(B.fact_order_detail(spark, SF_SMALL)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().sparkPlan().toString()
        joins = [ln for ln in plan.splitlines() if "Join" in ln]
        # the 2k ids are the build side of the semi joins; nothing of unknown size is broadcast by force
        names = [ln for ln in joins if "LeftOuter" in ln and re.search(r"\[product_[ab]#", ln)]
        semi = [ln for ln in joins if "LeftSemi" in ln]
        assert len(names) == 2 and not any("Broadcast" in ln for ln in names)
        assert len(semi) == 2 and all("BroadcastHashJoin" in ln and "BuildRight" in ln for ln in semi)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_no_driver_collection_in_operators():
    for path in (ROOT / "shoplake" / "operators").glob("*.py"):
        text = path.read_text()
        # k pairs of a top-k round; one (block, norm) pair per block of items
        assert ".toPandas(" not in text and text.count(".collect()") == {"baskets.py": 1, "ml.py": 1}.get(path.name, 0), path


def test_run_job_writes_results(spark):
    out = tempfile.mkdtemp(prefix="shoplake-job-")
    tables = B.business_tables(spark, SF_SMALL)
    written = jobs.run_job(spark, "etl", tables, out, as_of="2001-08-02")
    assert set(written) >= {"daily_trade", "user_rfm", "payment_dist"}
    back = spark.read.option("header", True).option("sep", "\t").csv(written["daily_trade"])
    assert back.count() == E.queries()["daily_trade"](spark, SF_SMALL).count()
    assert len([f for f in os.listdir(written["daily_trade"]) if f.startswith("part-")]) == 1


def test_product_and_ml_jobs_without_order_lines(spark):
    tables = B.business_tables(spark, SF_SMALL)
    del tables["fact_order_detail"]
    out = tempfile.mkdtemp(prefix="shoplake-job-")
    written = jobs.run_job(spark, "product", tables, out)
    assert set(written) == {"category_ranking", "brand_top3", "top_margin_products", "price_distribution"}
    head = spark.read.option("header", True).option("sep", "\t").csv(written["category_ranking"])
    assert "avg_profit_per_item" in head.columns
    with_id = dict(tables, fact_order=tables["fact_order"].withColumn("product_id", F.col("order_id") % 50))
    head = jobs.product_results(with_id, clean.dwd_order(with_id["fact_order"]))[0]["category_ranking"]
    assert "order_cnt" in head.columns and head.count() > 0
    assert set(jobs.run_job(spark, "ml", tables, out)) == {"user_clusters", "cluster_summary", "cluster_quality"}


def test_fits_do_not_depend_on_the_number_of_partitions(spark):
    got = []
    for parts in (2, 8):
        other = spark.newSession()
        other.conf.set("spark.sql.shuffle.partitions", str(parts))
        r = ml.ratings(B.fact_order_detail(other, SF_SMALL), B.fact_order(other, SF_SMALL))
        res = ml.cluster_results(clean.dwd_order(B.fact_order(other, SF_SMALL)))
        got.append((round(ml.als_fit_evaluate(r)[3], 6), sorted(map(tuple, res["cluster_summary"].collect())),
                    sorted((r.cluster, round(r.silhouette, 4)) for r in res["cluster_quality"].collect())))
    assert got[0] == got[1]


def test_item_blocks_do_not_change_recommendations(spark):
    r = ml.ratings(B.fact_order_detail(spark, SF_SMALL), B.fact_order(spark, SF_SMALL))
    model = ml.als_fit(r)
    one = {tuple(x) for x in ml.recommend(model, 5).select("user_id_idx", "product_id_idx").collect()}
    many = {tuple(x) for x in ml.recommend(model, 5, item_block=40, user_block=7, copies=2)
            .select("user_id_idx", "product_id_idx").collect()}
    assert one == many


def test_snapshot_round_trip(spark):
    from shoplake.schemas import FACT_ORDER
    from shoplake.sources import snapshot
    root = tempfile.mkdtemp(prefix="shoplake-lake-")
    o = B.fact_order(spark, SF_SMALL)
    snapshot.write_snapshot(o, root, "fact_order", "2026-05-18")
    back = snapshot.read_snapshot(spark, root, "fact_order", "2026-05-18", FACT_ORDER.__class__(
        [f for f in FACT_ORDER.fields if f.name in o.columns]))
    assert back.count() == o.count()
    dwd_a = sorted(tuple(r) for r in clean.dwd_order(back).collect())
    dwd_b = sorted(tuple(r) for r in clean.dwd_order(o).collect())
    assert dwd_a == dwd_b


def test_salting_equals_plain_on_testdata(spark):
    d = B.fact_order_detail(spark, SF_SMALL)
    a = baskets.co_purchase(d, split_above=2).exceptAll(baskets.co_purchase(d, split_above=None))
    assert a.count() == 0
    p = B.dim_product(spark, SF_SMALL)
    assert products.category_sales(d, p, orders=clean.valid_orders(B.fact_order(spark, SF_SMALL))).count() > 0


def test_bucketed_lake_join_has_no_shuffle(spark):
    from shoplake.operators import ml as mlops
    from shoplake.sources import snapshot
    root = tempfile.mkdtemp(prefix="shoplake-bucket-")
    snapshot.save_bucketed(B.fact_order(spark, SF_SMALL), "b_orders", "order_id", 8, f"{root}/o")
    snapshot.save_bucketed(B.fact_order_detail(spark, SF_SMALL), "b_lines", "order_id", 8, f"{root}/l")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = mlops.ratings(spark.table("b_lines"), spark.table("b_orders"))
        plan = r._jdf.queryExecution().executedPlan().toString()
        join_part = plan[plan.index("SortMergeJoin"):]
        assert "Exchange hashpartitioning(order_id" not in join_part
        assert r.count() == E.queries()["ratings"](spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_scale_conf():
    from shoplake.session import scale_conf
    assert scale_conf(100 * 1024 ** 4, 8000)["spark.sql.shuffle.partitions"] == "100000"
    assert scale_conf(10 * 1024 ** 4, 8000)["spark.sql.shuffle.partitions"] == "81920"
    assert scale_conf(1024 ** 3, 8000)["spark.sql.shuffle.partitions"] == "24000"


def test_lake_round_trip_runs_every_job(spark):
    from shoplake.sources import snapshot
    root = tempfile.mkdtemp(prefix="shoplake-lake-all-")
    src = B.business_tables(spark, SF_SMALL)
    for name, df in src.items():
        schema = snapshot.TABLES[name]
        cols = [F.col(c) if c in df.columns else F.lit(None).cast(schema[c].dataType).alias(c)
                for c in schema.fieldNames()]
        snapshot.write_snapshot(df.select(*cols), root, name, "2026-05-18")
    lake = snapshot.lake_tables(spark, root, "2026-05-18")
    out = tempfile.mkdtemp(prefix="shoplake-ads-")
    written = jobs.run_job(spark, "all", lake, out, as_of="2001-08-02")
    assert {"daily_trade", "rfm_segmentation", "co_occurrence", "user_top5_recs",
            "user_clusters"} <= set(written)
    daily = spark.read.option("header", True).option("sep", "\t").csv(written["daily_trade"])
    assert daily.count() == E.queries()["daily_trade"](spark, SF_SMALL).count()
    coh_lake = sorted(tuple(r) for r in spark.read.option("header", True).option("sep", "\t")
                      .csv(written["cohort_conversion"]).select("register_month", "registered_users")
                      .collect())
    coh = sorted((r.register_month, str(r.registered_users))
                 for r in E.queries()["cohort_conversion"](spark, SF_SMALL).collect())
    assert coh_lake == coh


def test_catalog_registration_and_scans(spark):
    from shoplake.sources import snapshot
    root = tempfile.mkdtemp(prefix="shoplake-cat-")
    o = B.fact_order(spark, SF_SMALL)
    path = snapshot.write_snapshot(o, root, "fact_order", "2026-05-18")
    snapshot.create_database(spark, "ods_test", f"{root}/db")
    schema = snapshot.TABLES["fact_order"].__class__(
        [f for f in snapshot.TABLES["fact_order"].fields if f.name in o.columns])
    name = snapshot.register_snapshot(spark, "ods_test", "fact_order", path, schema)
    assert "fact_order" in {r.tableName for r in snapshot.list_tables(spark, "ods_test").collect()}
    scan = snapshot.read_catalog_table(spark, name, ["order_id", "user_id", "order_status"],
                                       "order_status IN ('paid', 'shipped', 'completed')")
    assert scan.count() == clean.valid_orders(o, min_amount=None).count()
    assert snapshot.optional_table(spark, "ods_test.fact_order_detail") is None
    assert snapshot.optional_table(spark, name) is not None
    current = spark.catalog.currentDatabase()
    snapshot.use_database(spark, "ods_test")
    try:
        assert spark.table("fact_order").count() == o.count()
    finally:
        snapshot.use_database(spark, current)


def test_tsv_snapshot_nulls_and_quotes(spark):
    from shoplake.schemas import DIM_PRODUCT
    from shoplake.sources import snapshot
    root = tempfile.mkdtemp(prefix="shoplake-tsv-")
    rows = [(1, 'say "hi"', "C", None, 10.5, None, 3, None, "2026-05-01 10:00:00"),
            (2, "plain", None, "B", None, 1.25, None, "2026-01-01", None)]
    df = spark.createDataFrame(rows, DIM_PRODUCT)
    snapshot.write_snapshot(df, root, "dim_product", "2026-05-18")
    back = snapshot.read_snapshot(spark, root, "dim_product", "2026-05-18")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_command_line_job():
    import subprocess
    out = tempfile.mkdtemp(prefix="shoplake-cli-")
    proc = subprocess.run(
        [sys.executable, "-m", "shoplake", "etl", "--testdata", SF_SMALL, "--out", f"{out}/ads",
         "--as-of", "2001-08-02", "--master", "local[2]"],
        cwd=str(ROOT), capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    written = dict(line.split("\t") for line in proc.stdout.strip().splitlines())
    assert {"daily_trade", "user_rfm", "kpi_dashboard"} <= set(written)
    assert os.path.isdir(written["daily_trade"])
