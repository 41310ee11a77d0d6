"""Exact quantiles (linear interpolation) without collecting the values anywhere.

``percentile`` keeps a map of every distinct value in one aggregation buffer
and merges all of them in the final task of a global aggregate; with billions
of distinct money values that task runs out of memory.  Here a first pass
brackets each wanted rank: ``percentile_approx`` has a rank error of at most
n / ``ACCURACY``, so the values at p - 3/ACCURACY and p + 3/ACCURACY enclose
it with two ranks to spare, once n reaches ACCURACY (fewer rows are one bracket).  The second pass counts the rows below each bracket and the distinct
values inside (a 6/ACCURACY share of the rows), ranks those, and
reads off the two order statistics around the position.  The brackets are
plain numbers, so every row is judged by its value alone, whatever the
partitioning or plan.

The position is ``pos = p * (n - 1)`` and the value interpolates linearly
between the order statistics around it, with weight ``t = pos - floor(pos)``,
evaluated as numpy / pandas do it (``lo + (hi - lo) * t`` for ``t < 0.5``,
else ``hi - (hi - lo) * (1 - t)``), so thresholds equal the reference's
``quantile`` to the last bit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def quantile_name(measure: str, p: float) -> str:
    return f"{measure}_q{round(p * 100):02d}"


def _brackets(df: DataFrame, cells: dict[str, Column], probs: Sequence[float], accuracy: int) -> list[tuple]:
    """(measure, p, n, low, high) with the wanted ranks between low and high; one aggregate row."""
    margin = 3 / accuracy
    edges = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    row = df.agg(*[F.struct(F.count(c).alias("n"), F.percentile_approx(c, edges, accuracy).alias("q")).alias(m)
                   for m, c in cells.items()]).first()
    out = []
    for m in cells:
        for k, p in enumerate(probs):
            if row[m]["n"]:
                low, high = row[m]["q"][2 * k:2 * k + 2]
                if row[m]["n"] < accuracy:
                    low, high = float("-inf"), float("inf")
                out.append((m, float(p), row[m]["n"], low, high))
    return out


def exact_quantiles(df: DataFrame, measures: Mapping[str, Column | str],
                    probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row with a column ``<measure>_q<pp>`` per measure and probability.

    Runs the bracketing pass when called.  NULL values are ignored; a measure
    with no values gives NULL.
    """
    cells = {m: (F.col(c) if isinstance(c, str) else c).cast("double") for m, c in measures.items()}
    brackets = _brackets(df, cells, probs, accuracy)
    # a bracket's rows keep their value, rows below it count under NULL
    inside = [F.when(cells[m] <= F.lit(high), F.struct(
        F.lit(i).alias("k"), F.when(cells[m] >= F.lit(low), cells[m]).alias("v")))
        for i, (m, _, _, low, high) in enumerate(brackets)]
    wanted = F.array(*inside) if inside else F.array().cast("array<struct<k:int,v:double>>")
    counts = (df.select(F.explode(wanted).alias("x")).where(F.col("x").isNotNull())
              .groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("c")))
    upto = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("last", F.sum("c").over(upto) - 1)      # 0-based last rank of the value

    def order_statistic(k: int, rank: int) -> Column:
        hit = (F.col("k") == k) & F.col("v").isNotNull() & (F.col("last") >= rank) & (F.col("last") - F.col("c") < rank)
        return F.max(F.when(hit, F.col("v")))

    place = {(m, p): (k, n) for k, (m, p, n, _, _) in enumerate(brackets)}
    out = []
    for m in measures:
        for p in probs:
            name = quantile_name(m, p)
            if (m, float(p)) not in place:
                out.append(F.max(F.lit(None).cast("double")).alias(name))
                continue
            k, n = place[m, float(p)]
            pos = float(p) * (n - 1)
            t = pos - int(pos)
            lo, hi = order_statistic(k, int(pos)), order_statistic(k, -int(-pos // 1))
            value = hi - (hi - lo) * F.lit(1 - t) if t >= 0.5 else lo + (hi - lo) * F.lit(t)
            out.append(F.coalesce(value, F.raise_error(F.lit(f"{name}: rank outside its bracket")).cast("double")).alias(name))
    return ranked.agg(*out)
