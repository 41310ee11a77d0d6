"""K2 + K5: result writers and display.

Large results are written by all tasks in parallel; ``single_file=True``
(one output file, as the dashboards of the reference expect) is allowed only
for small summaries, because it funnels the last stage into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_result(df: DataFrame, path: str, fmt: str = "tsv", single_file: bool = False,
                 mode: str = "overwrite") -> str:
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode)
    if fmt == "tsv":
        w.option("header", "true").option("sep", "\t").csv(path)
    else:
        w.format(fmt).save(path)
    return path


def show(df: DataFrame, n: int = 20) -> None:
    """K5: print the first rows (job edge only; never inside an operator)."""
    df.show(n, truncate=False)
