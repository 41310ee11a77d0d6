"""Late rows as an output of their own.

A windowed streaming aggregate drops the rows of windows that the watermark has
closed; Spark only counts them.  Here each micro-batch is written once, split
into kept and late rows, so nothing is lost: kept plus late is the input, and
late rows can be examined or merged into corrected totals.

A batch's rows are judged as Spark's stateful operators judge them: the latest
event time of all batches before the previous one, less the delay, is the
watermark; a row is late when its window ended at or before it.  The folder of
a batch is replaced when the batch runs again after a failure, and a batch
counts once its mark (latest event time) is written after its rows, so a
restart neither loses nor repeats rows.  No state is kept in memory: the marks
are one row per batch.

Rows without event time belong to no window and go with the late ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.functions.labels import WATERMARK_DELAY, WINDOW_DURATION
from shoplake.session import shared_dir
from shoplake.streaming.io import file_stream
from shoplake.streaming.windows import event_time

MARK = "batch bigint, newest timestamp"


def _marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MARK).parquet(f"{path}/marks")


def _writer(path: str, time_col: str, window: str, delay: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.createDataFrame([], MARK).write.mode("append").parquet(f"{path}/marks")       # gives the folder its place
        newest = _marks(spark, path).where(F.col("batch") < batch_id - 1).agg(
            F.max("newest") - F.expr(f"INTERVAL {delay}")).first()[0]
        at = event_time(batch, time_col)
        # the window's end by arithmetic: F.window would drop rows without event time
        width = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + INTERVAL {window})")
        end = F.unix_micros(at) - F.pmod(F.unix_micros(at), width) + width
        late = at.isNull() if newest is None else F.coalesce(end <= F.unix_micros(F.lit(newest)), F.lit(True))
        rows = f"{path}/rows/batch={batch_id}"
        (batch.withColumn("_late", late).write.mode("overwrite").partitionBy("_late").parquet(rows))
        written = spark.read.schema(batch.schema).parquet(rows)
        if _marks(spark, path).where(F.col("batch") == batch_id).isEmpty():
            (written.agg(F.lit(batch_id).cast("long").alias("batch"), F.max(event_time(written, time_col)).alias("newest"))
             .write.mode("append").parquet(f"{path}/marks"))
    return write


def start_split(stream: DataFrame, path: str, checkpoint: str, time_col: str, window: str = WINDOW_DURATION,
                delay: str = WATERMARK_DELAY, available_now: bool = False, processing_time: str | None = None):
    """Start the query that writes every micro-batch of ``stream`` under ``path``, split by lateness."""
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(_writer(path, time_col, window, delay)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def split_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows of the finished batches with ``batch`` and ``late``."""
    from pyspark.sql.types import BooleanType, IntegerType, StructType
    done = _marks(spark, path).select(F.col("batch").cast("int").alias("batch")).distinct()
    full = StructType(list(schema.fields)).add("batch", IntegerType()).add("_late", BooleanType())
    rows = spark.read.schema(full).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.join(done, "batch", "left_semi").withColumnRenamed("_late", "late")


def kept_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return split_rows(spark, path, schema).where(~F.col("late")).drop("late")


def late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return split_rows(spark, path, schema).where("late").drop("late")


def split_arrivals(table: DataFrame, arrival: str, time_col: str, arrivals: int, window: str = WINDOW_DURATION,
                   delay: str = WATERMARK_DELAY) -> DataFrame:
    """Stream a static table in ``arrivals`` steps (column ``arrival``, 0, 1, ...) and split its rows by lateness.

    Each step appends its rows to the source folder and resumes the query from
    its checkpoint, as a restarted driver does; a step is one micro-batch.
    """
    spark = table.sparkSession
    base = shared_dir(spark, "late-split")
    rows = table.drop(arrival)
    for step in range(arrivals):
        table.where(F.col(arrival) == step).drop(arrival).write.mode("append").parquet(f"{base}/source")
        q = start_split(file_stream(spark, f"{base}/source", rows.schema), f"{base}/out", f"{base}/checkpoint", time_col,
                        window, delay, available_now=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return split_rows(spark, f"{base}/out", rows.schema)
