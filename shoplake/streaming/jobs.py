"""The two live streaming queries, wired end to end.

``raw`` is any streaming frame with a ``value`` column: ``read_kafka(...)``
on a cluster (S10/S11), or ``json_lines_stream(...)`` over a folder.  The
payload is parsed (F12), event time and a 5 s watermark are applied (P11,
X1), the tumbling aggregate runs (X2/X3), and the result goes to a file sink
(K3, JSON by default) or the console (K4).  Append mode emits each window
once, when the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shoplake.functions.labels import WATERMARK_DELAY, WINDOW_DURATION
from shoplake.streaming.io import (parse_behavior, parse_orders, start_console_sink,
                                   start_file_sink)
from shoplake.streaming.windows import behavior_uv_pv, order_window_totals


def behavior_uv_pv_stream(raw: DataFrame, window: str = WINDOW_DURATION,
                          delay: str = WATERMARK_DELAY, exact: bool = True) -> DataFrame:
    return behavior_uv_pv(parse_behavior(raw), "behavior_time", window, delay, exact)


def order_totals_stream(raw: DataFrame, window: str = WINDOW_DURATION,
                        delay: str = WATERMARK_DELAY,
                        statuses: Sequence[str] | None = None) -> DataFrame:
    return order_window_totals(parse_orders(raw), "order_time", window, delay, statuses)


def _start(result: DataFrame, path: str | None, checkpoint: str | None, fmt: str,
           processing_time: str | None, available_now: bool):
    if path is None:
        return start_console_sink(result)
    if checkpoint is None:
        raise ValueError("a file sink needs a checkpoint location")
    return start_file_sink(result, path, checkpoint, fmt=fmt, available_now=available_now,
                           processing_time=processing_time)


def start_behavior_uv_pv(raw: DataFrame, path: str | None = None, checkpoint: str | None = None,
                         fmt: str = "json", processing_time: str | None = "1 minute",
                         available_now: bool = False, **kw):
    """Per-minute UV/PV per behaviour; console when ``path`` is None."""
    return _start(behavior_uv_pv_stream(raw, **kw), path, checkpoint, fmt, processing_time,
                  available_now)


def start_order_totals(raw: DataFrame, path: str | None = None, checkpoint: str | None = None,
                       fmt: str = "json", processing_time: str | None = "1 minute",
                       available_now: bool = False, **kw):
    """Per-minute order count, amount sum and mean."""
    return _start(order_totals_stream(raw, **kw), path, checkpoint, fmt, processing_time,
                  available_now)
