"""Explicit schemas: the five business tables and the two stream payloads.

Lake types follow the snapshot column lists (money as DOUBLE, dates and
datetimes as STRING, quantity widened to BIGINT); readers always pass these
schemas, nothing is inferred.
"""

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


DIM_USER = _s(("user_id", LongType()), ("user_name", StringType()), ("gender", StringType()),
              ("age", IntegerType()), ("city", StringType()), ("register_date", StringType()),
              ("vip_level", IntegerType()), ("create_time", StringType()))

DIM_PRODUCT = _s(("product_id", LongType()), ("product_name", StringType()),
                 ("category", StringType()), ("brand", StringType()), ("price", DoubleType()),
                 ("cost", DoubleType()), ("stock", IntegerType()), ("launch_date", StringType()),
                 ("create_time", StringType()))

FACT_ORDER = _s(("order_id", LongType()), ("user_id", LongType()), ("order_status", StringType()),
                ("order_amount", DoubleType()), ("discount_amount", DoubleType()),
                ("actual_amount", DoubleType()), ("payment_method", StringType()),
                ("order_time", StringType()), ("pay_time", StringType()),
                ("create_time", StringType()), ("update_time", StringType()))

FACT_ORDER_DETAIL = _s(("detail_id", LongType()), ("order_id", LongType()),
                       ("product_id", LongType()), ("quantity", LongType()),
                       ("unit_price", DoubleType()), ("subtotal", DoubleType()),
                       ("create_time", StringType()))

USER_BEHAVIOR = _s(("log_id", LongType()), ("user_id", LongType()), ("product_id", LongType()),
                   ("behavior_type", StringType()), ("behavior_time", StringType()),
                   ("session_id", StringType()), ("ip", StringType()),
                   ("create_time", StringType()))

TABLES = {
    "dim_user": DIM_USER,
    "dim_product": DIM_PRODUCT,
    "fact_order": FACT_ORDER,
    "fact_order_detail": FACT_ORDER_DETAIL,
    "ods_user_behavior": USER_BEHAVIOR,
}

# Stream payloads (JSON values on the two topics).
BEHAVIOR_EVENT = StructType([
    StructField("log_id", LongType()),
    StructField("user_id", LongType()),
    StructField("product_id", LongType()),
    StructField("behavior_type", StringType()),
    StructField("behavior_time", TimestampType()),
    StructField("session_id", StringType()),
    StructField("ip", StringType()),
])

ORDER_ITEM = StructType([
    StructField("product_id", LongType()),
    StructField("quantity", IntegerType()),
    StructField("unit_price", DoubleType()),
    StructField("subtotal", DoubleType()),
])

ORDER_EVENT = StructType([
    StructField("order_id", LongType()),
    StructField("user_id", LongType()),
    StructField("order_status", StringType()),
    StructField("order_amount", DoubleType()),
    StructField("discount_amount", DoubleType()),
    StructField("actual_amount", DoubleType()),
    StructField("payment_method", StringType()),
    StructField("order_time", TimestampType()),
    StructField("items", ArrayType(ORDER_ITEM)),
])

