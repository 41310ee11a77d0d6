"""Guardrails over every registered query plan (static, no execution)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplake.plans import registry

# streaming runs execute when called
SKIP = {"behavior_uv_pv_stream", "order_window_totals_stream", "order_item_totals_stream", "late_split"}
NAMES = sorted(set(registry.QUERIES) - SKIP)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "percentile(")
# fits run when called; only cross joins are looked for in what they return
FITS = {"als_rmse", "als_top5", "als_top5_contract", "user_clusters", "cluster_summary", "cluster_quality", "cluster_contract",
        "scaled_features", "als_checked", "cluster_checked"}


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_cross_join_python_or_single_buffer_percentile(spark, name):
    qe = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution()
    plan = qe.optimizedPlan().toString() + qe.executedPlan().toString()
    assert not [f for f in (FORBIDDEN[:2] if name in FITS else FORBIDDEN) if f in plan]


def test_salting_and_scalar_subquery_are_in_the_plans(spark):
    co = E.queries()["co_purchase"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(0" in co            # right side copied per salt bucket
    terc = E.queries()["rfm_tercile"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in terc and "Join" not in terc.split("scalar-subquery")[0]


ML_CONTRACT = {
    "als_rmse": "train_rows bigint, test_rows bigint, rmse double",
    "als_top5": "user_id bigint, product_id bigint, product_name string, category string, score double",
    "user_clusters": "user_id bigint, cluster int, order_cnt bigint, total_spent double, "
                     "avg_order_value double",
    "cluster_summary": "cluster int, user_cnt bigint, avg_orders double, avg_spent double, "
                       "avg_aov double",
    "cluster_quality": "cluster int, centre_order_cnt double, centre_total_spent double, "
                       "centre_aov double, silhouette double",
}


@pytest.mark.parametrize("name", sorted(ML_CONTRACT))
def test_rows_only_queries_keep_their_contract(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    assert got == ML_CONTRACT[name]


def test_every_query_has_unique_column_names(spark):
    for name in sorted(set(NAMES) - FITS):
        cols = E.queries()[name](spark, SF_SMALL).columns
        assert cols and len(cols) == len(set(cols)), name
