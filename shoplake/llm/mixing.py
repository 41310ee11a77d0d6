"""Mixing sources to target weights.

Tokens (words) are summed per source, each source gets a target share of all
tokens, and the repetition rate of a source is target / size.  A document is
emitted floor(rate) times, plus one more copy when its seeded hash falls below
the fractional part.

Targets: the sources, ordered by code point with null last, weigh 5, 2, 1,
5, 2, 1, ... and share all tokens in proportion.  No target exceeds
``max_repeat`` times its source's size; what a capped source leaves over is
shared among the others by weight, until none is above its cap.

Scale: the text is read once for the sizes.  Sizes reduce to one row per
source before anything moves; the water level is computed over those rows
only.  Per-document work is a map: rates reach the documents by a broadcast
when the number of sources is at most ``broadcast_sources`` and by an ordinary
join (which AQE can split on a hot source) beyond it.

Edge cases: null text has size 0 and is still emitted; null source is a
source of its own; an empty table gives no rows; rows without doc_id, or that
repeat one, draw by their text as well, so only rows equal in both draw the same
number as each other (and are taken equally often).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, stored, text_hash, text_of

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-2024"
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words of a text."""
    return F.size(F.array_remove(F.split(text, SPACE), "")).cast("long")


def draw(doc_id: Column, mark: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) from 52 bits of the MD5 of seed, id and the hash of the text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), mark))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, size) rows -> one row per source: source, source_size, target, rate.

    Water filling in closed form: with the sources sorted by cap / weight, the
    capped ones are the prefix whose cap lies below the level that the rest
    would get, so one pass of running sums finds the level.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = (totals.withColumn("weight", w.cast("long"))
              .withColumn("cap", F.col("source_size") * max_repeat)
              .withColumn("fill", F.col("cap") / F.col("weight")))
    before = (Window.orderBy("fill", F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    everyone = Window.partitionBy()
    lev = (ranked
           .withColumn("all_size", F.sum("source_size").over(everyone))
           .withColumn("all_weight", F.sum("weight").over(everyone))
           .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
           # the level if exactly the sources before this one were capped
           .withColumn("level", (F.col("all_size") - F.col("cap_before")).cast("double")
                       / (F.col("all_weight") - F.col("weight_before")).cast("double"))
           .withColumn("open", F.col("fill") >= F.col("level"))
           .withColumn("final_level", F.min(F.when(F.col("open"), F.struct("fill", "level"))).over(everyone)["level"]))
    target = F.when(F.col("open"), F.col("final_level") * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return lev.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(1.0)).alias("rate"))


def mix_plan(docs: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED,
             broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    sized = docs.select("doc_id", "source", word_count(text_of("text")).alias("size"), text_hash("text").alias("_mark"))
    return _with_copies(sized, _rates(sized, weights, max_repeat), seed, broadcast_sources).drop("_mark")


def _rates(sized: DataFrame, weights: tuple, max_repeat: int) -> DataFrame:
    return stored(source_targets(sized.select("source", "size"), weights, max_repeat), "mix-rates")


def _with_copies(sized: DataFrame, rates: DataFrame, seed: str, broadcast_sources: int) -> DataFrame:
    r = rates.withColumnRenamed("source", "_source")
    if r.count() <= broadcast_sources:
        r = F.broadcast(r)
    copies = (F.floor("rate") + (draw(F.col("doc_id"), F.col("_mark"), seed) < F.col("rate") - F.floor("rate")).cast("long"))
    return (sized.join(r, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("copies", copies.cast("long"))
            .withColumn("taken", F.col("size") * F.col("copies")))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED,
        broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, columns unchanged."""
    sized = docs.select("doc_id", "source", word_count(text_of("text")).alias("size"))
    rates = _rates(sized, weights, max_repeat)
    row = docs.select("doc_id", "source", text_hash("text").alias("_mark"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    picked = _with_copies(row.withColumn("size", F.lit(0).cast("long")), rates, seed, broadcast_sources)
    # repeat 0 times: sequence(1, 0) would count down, so rows without copies go first
    return (picked.filter(F.col("copies") > 0)
            .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
            .select("_row.*"))
