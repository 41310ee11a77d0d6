"""Bind the supplied TESTDATA tables to the five business tables.

The expressions are plain SQL so that the DuckDB oracle can use the very same
text (see ``BINDING_SQL``).  Columns without a source column are derived by a
deterministic rule from the key.  Every binding is a projection (plus one
join to the 25-row ``nation`` table), so Catalyst prunes the parquet scan to
the referenced columns and pushes filters on plain columns into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DIM_USER_COLS = {
    "user_id": "c_custkey",
    "user_name": "c_name",
    "gender": "CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'U' END",
    "age": "CAST(18 + c_custkey % 42 AS INT)",
    "city": "n_name",
    "register_date": "DATE '1995-01-01' + CAST(c_custkey % 365 AS INT)",
    "vip_level": "CAST(c_custkey % 4 AS INT)",
}

DIM_PRODUCT_COLS = {
    "product_id": "p_partkey",
    "product_name": "p_name",
    "category": "p_type",
    "brand": "p_brand",
    "price": "CAST(p_retailprice AS DECIMAL(18,2))",
    "cost": "CAST(p_retailprice AS DECIMAL(18,2)) - CAST(100 + p_partkey % 700 AS DECIMAL(18,2))",
    "stock": "p_size",
}

FACT_ORDER_COLS = {
    "order_id": "o_orderkey",
    "user_id": "o_custkey",
    "order_status": ("CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'paid' "
                     "ELSE 'pending' END"),
    "order_amount": "CAST(o_totalprice AS DECIMAL(18,2))",
    "discount_amount": "CAST(o_orderkey % 50 AS DECIMAL(18,2))",
    "actual_amount": ("CAST(o_totalprice AS DECIMAL(18,2)) - "
                      "CAST(o_orderkey % 50 AS DECIMAL(18,2))"),
    "payment_method": "o_orderpriority",
    "order_time": "o_orderdate",
}

FACT_ORDER_DETAIL_COLS = {
    "detail_id": "l_linenumber",
    "order_id": "l_orderkey",
    "product_id": "l_partkey",
    "quantity": "CAST(l_quantity AS BIGINT)",
    "subtotal": "CAST(l_extendedprice AS DECIMAL(18,2))",
}

BEHAVIOR_COLS_SPARK = {
    "log_id": "event_id",
    "user_id": "user_id",
    "product_id": "from_json(props, 'k bigint').k",
    "behavior_type": "event_type",
    "behavior_time": "ts",
}
BEHAVIOR_COLS_SQL = dict(BEHAVIOR_COLS_SPARK,
                         product_id="CAST(json_extract_string(props, '$.k') AS BIGINT)")


def _select(cols: dict) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in cols.items())


# The same bindings as SQL views for the DuckDB oracle (tables are registered
# under their TESTDATA names there).
BINDING_SQL = {
    "dim_user": (f"SELECT {_select(DIM_USER_COLS)} "
                 "FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "dim_product": f"SELECT {_select(DIM_PRODUCT_COLS)} FROM part",
    "fact_order": f"SELECT {_select(FACT_ORDER_COLS)} FROM orders",
    "fact_order_detail": f"SELECT {_select(FACT_ORDER_DETAIL_COLS)} FROM lineitem",
    "ods_user_behavior": f"SELECT {_select(BEHAVIOR_COLS_SQL)} FROM events",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _project(df: DataFrame, cols: dict) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in cols.items()])


def bind_orders(orders: DataFrame) -> DataFrame:
    return _project(orders, FACT_ORDER_COLS)


def bind_events(events: DataFrame) -> DataFrame:
    return _project(events, BEHAVIOR_COLS_SPARK)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    return _project(c.join(n, c.c_nationkey == n.n_nationkey, "inner"), DIM_USER_COLS)


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(read_table(spark, sf_dir, "part"), DIM_PRODUCT_COLS)


def fact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_orders(read_table(spark, sf_dir, "orders"))


def fact_order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(read_table(spark, sf_dir, "lineitem"), FACT_ORDER_DETAIL_COLS)


def user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_events(read_table(spark, sf_dir, "events"))


BINDERS = {
    "dim_user": dim_user,
    "dim_product": dim_product,
    "fact_order": fact_order,
    "fact_order_detail": fact_order_detail,
    "ods_user_behavior": user_behavior,
}


def business_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five business tables as lazy DataFrames."""
    return {name: fn(spark, sf_dir) for name, fn in BINDERS.items()}
