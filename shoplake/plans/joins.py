"""Join policy for fact-to-dimension lookups.

No dimension is ever broadcast by force.  ``broadcast=True`` (default) lets
Spark decide: the planner broadcasts the dimension only when its estimated
size is below ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks
the materialised size (``spark.sql.adaptive.autoBroadcastJoinThreshold``)
before choosing a broadcast; a larger dimension gets a shuffled sort-merge
join.  ``broadcast=False`` forbids broadcasting (a sort-merge join always).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             broadcast: bool = True) -> DataFrame:
    if not broadcast:
        dim = dim.hint("shuffle_merge")
    return fact.join(dim, on, how)
