"""Parallel JDBC snapshot reads of the business tables.

Each read is a query pushed to the database and split into ranges of a numeric
key, one task per range.  The bounds of the key and the row count come from
the source by one aggregate query, and the number of ranges follows from
``rows_per_partition``.  No database is available here: tests check the
options and the statements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# FIXED VALUES: query text per table, the business columns with datetimes rendered as text
SOURCE_QUERIES = {
    "dim_user": "SELECT user_id, user_name, gender, age, city, register_date, vip_level, "
                "DATE_FORMAT(create_time, '%Y-%m-%d %H:%i:%s') AS create_time FROM dim_user",
    "dim_product": "SELECT product_id, product_name, category, brand, price, cost, stock, launch_date, "
                   "DATE_FORMAT(create_time, '%Y-%m-%d %H:%i:%s') AS create_time FROM dim_product",
    "fact_order": "SELECT order_id, user_id, order_status, order_amount, discount_amount, actual_amount, "
                  "payment_method, order_time, pay_time, "
                  "DATE_FORMAT(create_time, '%Y-%m-%d %H:%i:%s') AS create_time, "
                  "DATE_FORMAT(update_time, '%Y-%m-%d %H:%i:%s') AS update_time FROM fact_order",
    "fact_order_detail": "SELECT detail_id, order_id, product_id, quantity, unit_price, subtotal, create_time "
                         "FROM fact_order_detail",
    "ods_user_behavior": "SELECT log_id, user_id, product_id, behavior_type, behavior_time, session_id, ip, create_time "
                         "FROM user_behavior_log",
}
SPLIT_KEYS = {"dim_user": "user_id", "dim_product": "product_id", "fact_order": "order_id",
              "fact_order_detail": "detail_id", "ods_user_behavior": "log_id"}


def jdbc_options(url: str, query: str, partition_column: str, lower_bound: int,
                 upper_bound: int, num_partitions: int, user: str | None = None,
                 password: str | None = None, driver: str | None = None,
                 fetch_size: int = 10000) -> dict[str, str]:
    """Reader options: the query as a derived table, split into key ranges."""
    opts = {
        "url": url,
        "dbtable": f"({query}) t",
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
    }
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            opts[k] = v
    return opts


def bounds_query(query: str, partition_column: str) -> str:
    """One-row statement: least and greatest key and the number of rows of ``query``."""
    return (f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi, COUNT(*) AS n "
            f"FROM ({query}) q")


def partitions_for(rows: int, rows_per_partition: int) -> int:
    return max(1, -(-rows // rows_per_partition))


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str,
              rows_per_partition: int = 500_000, **kw) -> DataFrame:
    """Read ``query`` in key ranges; asks the source for the bounds first (one row)."""
    connection = {k: v for k, v in (("url", url), *kw.items()) if v is not None and k != "fetch_size"}
    found = (spark.read.format("jdbc").options(**connection)
             .option("dbtable", f"({bounds_query(query, partition_column)}) b").load().first())
    lo, hi = (0, 0) if found["lo"] is None else (int(found["lo"]), int(found["hi"]))
    opts = jdbc_options(url, query, partition_column, lo, hi + 1,
                        partitions_for(int(found["n"]), rows_per_partition), **kw)
    return spark.read.format("jdbc").options(**opts).load()


def read_business_table(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    return read_jdbc(spark, url, SOURCE_QUERIES[table], SPLIT_KEYS[table], **kw)
