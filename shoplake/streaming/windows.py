"""Per-window visitor and order totals, one definition for batch and stream.

The same function runs on a static DataFrame (the batch twin) and on a
streaming DataFrame (``readStream``): pass ``delay`` to put a watermark on
the event time for the streaming case.

Exact distinct users per window cannot be a ``count_distinct`` on a stream
(Spark rejects it), so UV is a two-level aggregate: ``(window, behaviour,
user) -> n`` then ``(window, behaviour) -> count(user), sum(n)``.  Both
levels are ordinary hash aggregates with map-side partial aggregation; the
state is one row per (window, behaviour, user) and is dropped when the
watermark passes the window.  ``count(user)`` skips the NULL user the way
``COUNT(DISTINCT user)`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from shoplake.functions.columns import money_sum, to_money
from shoplake.functions.labels import WINDOW_DURATION


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP of the same wall time read as UTC, independent of the
    session time zone (a plain cast would shift wall times a DST change skips)."""
    return F.concat(c.cast("string"), F.lit("Z")).cast("timestamp")


def instant_to_ntz(c: Column) -> Column:
    """Inverse of ``ntz_to_instant``: the UTC wall time of an instant, as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def event_time(df: DataFrame, col: str, fmt: str | None = None) -> Column:
    """A TIMESTAMP from a TIMESTAMP, TIMESTAMP_NTZ or text column.

    Watermarks require TIMESTAMP; Parquet timestamps often load as
    TIMESTAMP_NTZ, so they become the instant of the same wall time in UTC
    (and are turned back at the output), whatever the session time zone.
    """
    dt = df.schema[col].dataType
    if isinstance(dt, TimestampType):
        return F.col(col)
    if isinstance(dt, TimestampNTZType):
        return ntz_to_instant(F.col(col))
    if isinstance(dt, StringType):
        return F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt else F.col(col).try_cast("timestamp")
    return F.col(col).cast("timestamp")


def with_event_time(df: DataFrame, col: str, delay: str | None = None,
                    out: str = "event_time") -> DataFrame:
    """P11 + X1: add the event-time column and, for streams, the watermark.

    Without a watermark a TIMESTAMP_NTZ column is windowed as it is, so batch
    results never depend on the session time zone.
    """
    if delay is None and isinstance(df.schema[col].dataType, TimestampNTZType):
        return df.withColumn(out, F.col(col))
    df = df.withColumn(out, event_time(df, col))
    return df.withWatermark(out, delay) if delay else df


def window_bound(df: DataFrame, col: str, delay: str | None):
    """Maps a window bound back to TIMESTAMP_NTZ, matching how ``with_event_time`` built it."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return (lambda c: c) if delay is None else instant_to_ntz
    return lambda c: c.cast("timestamp_ntz")


def behavior_uv_pv(events: DataFrame, time_col: str = "behavior_time",
                   window: str = WINDOW_DURATION, delay: str | None = None,
                   exact: bool = True) -> DataFrame:
    """X2 + X4: per tumbling window and behaviour, distinct users (UV) and events (PV)."""
    df = with_event_time(events, time_col, delay)
    bound = window_bound(events, time_col, delay)
    w = F.window("event_time", window).alias("w")
    if exact:
        per_user = df.groupBy(w, "behavior_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
        out = per_user.groupBy("w", "behavior_type").agg(
            F.count("user_id").alias("uv"), F.sum("n").alias("pv"))
    else:
        out = df.groupBy(w, "behavior_type").agg(
            F.approx_count_distinct("user_id").alias("uv"), F.count(F.lit(1)).alias("pv"))
    return out.select(bound(F.col("w.start")).alias("window_start"), "behavior_type", "uv", "pv")


def order_window_totals(orders: DataFrame, time_col: str = "order_time",
                        window: str = WINDOW_DURATION, delay: str | None = None,
                        statuses: Sequence[str] | None = None,
                        amount_col: str = "actual_amount") -> DataFrame:
    """X3 + X4: per tumbling window, order count, amount sum and mean.

    All statuses count by default, cancelled ones too (D19); pass
    ``statuses`` to filter.
    """
    if statuses is not None:
        orders = orders.where(F.col("order_status").isin(*statuses))
    df = with_event_time(orders, time_col, delay)
    bound = window_bound(orders, time_col, delay)
    out = df.groupBy(F.window("event_time", window).alias("w")).agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum(amount_col).alias("total_amount"),
        F.count(to_money(amount_col)).alias("_n"))
    return out.select(
        bound(F.col("w.start")).alias("window_start"),
        bound(F.col("w.end")).alias("window_end"),
        "order_count", "total_amount",
        F.try_divide(F.col("total_amount"), F.col("_n")).alias("avg_amount"))


def explode_order_items(orders: DataFrame) -> DataFrame:
    """One row per order item from the nested ``items`` array."""
    keep = [c for c in orders.columns if c != "items"]
    return orders.select(*keep, F.inline_outer("items"))


ITEMS_PER_ROW = 1000
PART_ROWS = 64


def nested_orders(orders: DataFrame, details: DataFrame, item_cols: Sequence[str], limit: int = ITEMS_PER_ROW) -> DataFrame:
    """Orders with their items as nested arrays of about ``limit`` at most: the columns of ``orders``, ``part``, ``items``.

    An order of up to ``limit`` lines is one row.  A longer one is dealt by a
    hash of its lines into twice as many parts as it needs, so no row grows with
    a hot order.  Only orders above the limit enter the lookup of the part
    counts, in ``PART_ROWS`` copies that lines meet by a part of their hash.
    Orders without lines get no row, lines without an order none either.
    """
    sizes = details.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = sizes.select("order_id", F.ceil(F.col("_n") * 2 / limit).cast("int").alias("_parts"),
                       F.explode(F.sequence(F.lit(0), F.lit(PART_ROWS - 1))).alias("_copy"))
    h = F.xxhash64(*[F.col(c) for c in details.columns])
    lines = (details.withColumn("_copy", F.pmod(h, F.lit(PART_ROWS)).cast("int")).join(hot, ["order_id", "_copy"], "left")
             .withColumn("part", F.pmod(F.shiftright(h, 8), F.coalesce("_parts", F.lit(1))).cast("int")))
    items = lines.groupBy("order_id", "part").agg(F.collect_list(F.struct(*item_cols)).alias("items"))
    return items.join(orders, "order_id").select(*orders.columns, "part", "items")


def item_window_totals(orders: DataFrame, time_col: str = "order_time", window: str = WINDOW_DURATION,
                       delay: str | None = None) -> DataFrame:
    """X5 streamed: per tumbling window and product, lines, quantity and amount of the nested ``items``.

    The generator runs per row, before the aggregate; state is one row per
    (window, product) and goes when the watermark passes the window.  Orders
    without items add nothing.
    """
    df = with_event_time(orders, time_col, delay)
    bound = window_bound(orders, time_col, delay)
    # an outer generator: an inner one is filtered below the watermark, which then misses orders without items
    lines = df.select("event_time", F.explode_outer("items").alias("item")).where("item is not null").select("event_time", "item.*")
    out = lines.groupBy(F.window("event_time", window).alias("w"), "product_id").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("quantity").alias("quantity"), money_sum("subtotal").alias("amount"))
    return out.select(bound(F.col("w.start")).alias("window_start"), "product_id", "line_count", "quantity", "amount")
