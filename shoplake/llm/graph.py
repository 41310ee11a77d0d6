"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the neighbours of each node to the least node around it (large: only the greater neighbours)."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.col("_u")).alias("m"))
    joined = near.join(least, F.col("u") == F.col("_u"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) rows -> (node, root): the least node of the component, for every node of an edge.

    Each round is stored in the shared directory, so lineage stays one round
    long.  A hot node (the centre of a large component) has its least
    neighbour found by a partial aggregate, and its rows meet that one value
    in an ordinary join that AQE can split.  The rounds end when a round
    changes nothing: all edges then lead to a root.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .filter("u <> v").distinct(), "cc-0")
    mark = _mark(now)
    for i in range(1, MAX_ROUNDS):
        if mark[0] == 0:
            break
        now = stored(_star(_star(now, True), False), f"cc-{i}")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
    return tuple(row)
