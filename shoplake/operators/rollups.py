"""Mergeable states: quantile sketches and distinct counts that roll up.

A quantile or a distinct count of a month cannot be computed from those of its
days.  Their states can: per fine key (a day, a minute) one state is written
once, and any coarser key is a merge of these rows, without reading the facts
again.

* Quantiles: KLL sketches.  A sketch of size k has a rank error of at most
  2.296 / k^0.9723 of the rows with 99 % confidence, merged or not.
* Exact distinct counts: bitmaps over dense ids, one row per key and bucket of
  32,768 ids.  Merging is a bitwise or, so a day's count from minute bitmaps
  equals COUNT(DISTINCT) over the day.
* Approximate distinct counts: HyperLogLog states, a few KB per key whatever the ids.

Scale: building and merging are partial aggregates; a hot key sends one state
per task.  NULL values and ids are ignored, as COUNT(DISTINCT) and percentiles
do; a key without values gives a NULL quantile or a count of 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.operators.quantiles import quantile_name

KLL_K = 800
HLL_LG_K = 14


def rank_error(k: int = KLL_K) -> float:
    """Greatest normalised rank error of a KLL sketch of size k, with 99 % confidence."""
    return 2.296 / k ** 0.9723


def _cells(measures: Mapping[str, Column | str]) -> dict[str, Column]:
    return {m: (F.col(c) if isinstance(c, str) else c).cast("double") for m, c in measures.items()}


def quantile_sketches(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column | str], k: int = KLL_K) -> DataFrame:
    """One row per key with a column ``<measure>_kll`` for each measure."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(c, F.lit(k)).alias(f"{m}_kll") for m, c in _cells(measures).items()])


def merged_sketches(sketches: DataFrame, keys: Sequence[str], measures: Sequence[str], k: int = KLL_K) -> DataFrame:
    """The sketches of a coarser key (no key: one row for all)."""
    return sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(f"{m}_kll", F.lit(k)).alias(f"{m}_kll") for m in measures])


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], measures: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The keys and, per measure, ``<measure>_n`` and ``<measure>_q<pp>`` for each probability."""
    out = [F.col(c) for c in keys]
    for m in measures:
        n = F.kll_sketch_get_n_double(f"{m}_kll")
        out.append(n.alias(f"{m}_n"))
        out += [F.when(n > 0, F.kll_sketch_get_quantile_double(f"{m}_kll", F.lit(float(p)))).alias(quantile_name(m, p)) for p in probs]
    return sketches.select(*out)


def quantile_errors(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column | str], quantiles: DataFrame,
                    probs: Sequence[float]) -> DataFrame:
    """Rows (keys, measure, p, n, value, rank_error): how far the estimates of ``sketch_quantiles`` lie from their ranks.

    The rank of a value is any share between that of smaller rows and that of rows up to it.
    """
    cells = _cells(measures)
    facts = df.select(*keys, *[c.alias(f"_{m}") for m, c in cells.items()]).join(quantiles, list(keys))
    names = [(m, p, quantile_name(m, p)) for m in cells for p in probs]
    counted = facts.groupBy(*keys).agg(
        *[F.count(f"_{m}").alias(f"_n_{m}") for m in cells],
        *[F.first(q).alias(q) for _, _, q in names],
        *[F.count_if(F.col(f"_{m}") < F.col(q)).alias(f"_lt_{q}") for m, _, q in names],
        *[F.count_if(F.col(f"_{m}") <= F.col(q)).alias(f"_le_{q}") for m, _, q in names])
    rows = [F.struct(F.lit(m).alias("measure"), F.lit(float(p)).alias("p"), F.col(f"_n_{m}").alias("n"), F.col(q).alias("value"),
                     F.greatest(F.lit(0.0), F.try_divide(f"_lt_{q}", f"_n_{m}") - p, p - F.try_divide(f"_le_{q}", f"_n_{m}"))
                     .alias("rank_error")) for m, p, q in names]
    return counted.select(*keys, F.explode(F.array(*rows)).alias("_r")).select(*keys, "_r.*").where("n > 0")


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], dense_id: str) -> DataFrame:
    """One row per key and bucket of ids: bitmap ``bits`` of the ids that occur.  Ids are dense, from 0; NULL is skipped."""
    one = F.col(dense_id).cast("long") + 1                                     # bit positions count from one
    return (df.where(F.col(dense_id).isNotNull()).groupBy(*keys, F.bitmap_bucket_number(one).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits")))


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of a coarser key."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, keys: Sequence[str], name: str = "uv") -> DataFrame:
    """Distinct ids per key."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def distinct_states(df: DataFrame, keys: Sequence[str], col: str, lg_k: int = HLL_LG_K) -> DataFrame:
    """One row per key with the HyperLogLog state ``state`` of the values of ``col``."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, F.lit(lg_k)).alias("state"))


def state_counts(states: DataFrame, keys: Sequence[str], name: str = "uv") -> DataFrame:
    """Approximate distinct values per (coarser) key, from the merged states."""
    return states.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias(name))
