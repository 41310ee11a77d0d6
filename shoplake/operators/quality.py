"""Data-quality operators: row counts, minimum-row gate, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions.columns import to_money


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A28 + U1 + G3: ``(table_name, row_count)`` for every table, UNION ALL."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_gate(counts: DataFrame, minimums: Mapping[str, int]) -> DataFrame:
    """One row per checked table with ``passed`` (input: ``table_row_counts``)."""
    mins = counts.sparkSession.createDataFrame(
        sorted(minimums.items()), "table_name string, min_rows bigint")
    return (mins.join(counts, "table_name", "left")
            .select("table_name", "min_rows", F.coalesce("row_count", F.lit(0)).alias("row_count"),
                    (F.coalesce("row_count", F.lit(0)) >= F.col("min_rows")).alias("passed")))


def detail_reconciliation(details: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Lines whose subtotal differs from quantity x unit price by more than ``tolerance``."""
    expected = F.col("quantity") * to_money("unit_price")
    return (details.withColumn("expected_subtotal", expected.cast("double"))
            .where(F.abs(to_money("subtotal") - expected) > F.lit(tolerance)))
