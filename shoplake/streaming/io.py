"""Stream sources, payload parsing, sinks, and streaming runs over a table's files.

* ``read_kafka`` is a thin option builder over Spark's ``kafka`` source (the
  connector jar must be on the classpath; it is not in this environment).
* ``parse_json_values`` turns any frame with a ``value`` column (Kafka
  binary, or text lines from a file source) into typed rows.
* ``stream_table`` streams the files of a table through a query and closes its
  last windows with one sentinel row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.functions.labels import (BEHAVIOR_TOPIC, ORDER_TOPIC,  # noqa: F401 (re-exported)
                                       STREAM_TIMESTAMP_FORMAT, WATERMARK_DELAY, WINDOW_DURATION)
from shoplake.schemas import BEHAVIOR_EVENT, ORDER_EVENT
from shoplake.session import shared_dir
from shoplake.streaming.windows import behavior_uv_pv, item_window_totals, order_window_totals

SENTINEL_TIME = "2200-01-01 00:00:00"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                  group_id: str | None = None, max_offsets_per_trigger: int | None = None,
                  extra: dict | None = None) -> dict[str, str]:
    """S10/S11 + X6: source options for one topic, latest offsets, optional consumer group.

    ``max_offsets_per_trigger`` caps a micro-batch (e.g. after downtime), so
    catching up never builds one huge batch and its state in one go.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
               starting_offsets: str = "latest", group_id: str | None = None,
               max_offsets_per_trigger: int | None = None, extra: dict | None = None) -> DataFrame:
    """Kafka topic as a streaming frame (key, value, timestamp, ...)."""
    opts = kafka_options(bootstrap_servers, topic, starting_offsets, group_id,
                         max_offsets_per_trigger, extra)
    return spark.readStream.format("kafka").options(**opts).load()


def parse_json_values(raw: DataFrame, schema: StructType,
                      timestamp_format: str = STREAM_TIMESTAMP_FORMAT) -> DataFrame:
    """decode the JSON ``value`` column; malformed rows give NULL fields."""
    parsed = F.from_json(F.col("value").cast("string"), schema,
                         {"timestampFormat": timestamp_format, "mode": "PERMISSIVE"})
    return raw.select(parsed.alias("r")).select("r.*")


def parse_behavior(raw: DataFrame) -> DataFrame:
    return parse_json_values(raw, BEHAVIOR_EVENT)


def parse_orders(raw: DataFrame) -> DataFrame:
    return parse_json_values(raw, ORDER_EVENT)


def json_lines_stream(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-backed stand-in for a topic: each text line is one JSON ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def json_field(df: DataFrame, col: str, ddl: str, field: str) -> DataFrame:
    """Decode one field of a JSON text column (``from_json`` with a DDL schema)."""
    return df.withColumn(field, F.from_json(F.col(col), ddl).getField(field))


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def start_file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "json",
                    output_mode: str = "append", available_now: bool = False,
                    processing_time: str | None = None, query_name: str | None = None):
    """K3: streaming file sink (JSON by default) with a checkpoint location."""
    w = (df.writeStream.format(fmt).outputMode(output_mode)
         .option("path", path).option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def dropped_late_rows(query) -> int:
    """Rows a streaming query dropped as later than its watermark (all progress so far)."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p.get("stateOperators", []))


def start_console_sink(df: DataFrame, output_mode: str = "append", truncate: bool = False):
    """K4: console display of a streaming result (development only)."""
    return (df.writeStream.format("console").outputMode(output_mode)
            .option("truncate", str(truncate).lower()).start())


def stream_table(spark: SparkSession, path: str, query: Callable[[DataFrame], DataFrame], sentinel: dict,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None, name: str = "stream",
                 work_dir: str | None = None) -> DataFrame:
    """Run a streaming ``query`` over the files of a static table; return what it emitted.

    The table's own files are the stream source and are read once, in
    micro-batches of ``max_files_per_trigger`` files (all at once by default; set it where
    the files follow event time).  The first run takes the files, the second
    resumes from the checkpoint (the path a restarted driver takes) and reads
    one far-future ``sentinel`` row, the only row written, which moves the
    watermark past every real window.  Its own window stays open and is never emitted.
    ``query`` puts its watermark on the event time.

    State is kept in RocksDB.  Raises if any row was dropped as late.
    """
    base = work_dir or shared_dir(spark, name)
    out, ckpt, extra = f"{base}/output", f"{base}/checkpoint", f"{base}/sentinel"
    schema = spark.read.parquet(path).schema
    # an empty frame gives the folder its place; its schema is that of the table
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(extra)
    # the runs use their own session (same cluster, separate SQL conf)
    runner = spark.newSession()
    runner.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # a commit writes the changes of its batch, not a snapshot of all state
    runner.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # the count of state rows is not used; keeping it takes a lookup before every write and removal
    runner.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    # as a glob that matches itself, the path may be a folder or one file
    head, _, tail = path.rstrip("/").rpartition("/")
    files = f"{head}/{{{tail}}}"
    dropped = 0
    for final in (False, True):
        if final:
            row = spark.range(1).select(*[F.lit(sentinel.get(f.name)).cast(f.dataType).alias(f.name)
                                          for f in schema.fields])
            row.write.mode("append").parquet(extra)
        # only the last run needs the empty batch that emits the closed windows
        runner.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(final).lower())
        both = file_stream(runner, files, schema, "parquet", max_files_per_trigger).unionByName(
            file_stream(runner, extra, schema, "parquet"))
        result = query(both)
        q = start_file_sink(result, out, ckpt, fmt=fmt, available_now=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        dropped += dropped_late_rows(q)
    if dropped:
        raise RuntimeError(f"{dropped} rows came later than the watermark")
    return spark.read.format(fmt).schema(result.schema).load(out)


def stream_uv_pv(spark: SparkSession, path: str, bind: Callable[[DataFrame], DataFrame], sentinel: dict,
                 time_col: str = "behavior_time", window: str = WINDOW_DURATION, delay: str = WATERMARK_DELAY,
                 **kw) -> DataFrame:
    """X1 + X2 streamed: UV/PV per window over the files of an events table; ``bind`` maps its columns."""
    return stream_table(spark, path, lambda df: behavior_uv_pv(bind(df), time_col, window, delay), sentinel,
                        name="uvpv-stream", **kw)


def stream_order_totals(spark: SparkSession, path: str, bind: Callable[[DataFrame], DataFrame], sentinel: dict,
                        time_col: str = "order_time", window: str = WINDOW_DURATION, delay: str = WATERMARK_DELAY,
                        statuses: Sequence[str] | None = None, **kw) -> DataFrame:
    """X1 + X3 + K3 streamed: order totals per window written as JSON files.

    With ``statuses`` the sentinel row must have one of them: the filter runs before the watermark.
    """
    return stream_table(spark, path, lambda df: order_window_totals(bind(df), time_col, window, delay, statuses),
                        sentinel, fmt="json", name="order-totals-stream", **kw)


def stream_item_totals(spark: SparkSession, path: str, sentinel: dict, time_col: str = "order_time",
                       window: str = WINDOW_DURATION, delay: str = WATERMARK_DELAY, **kw) -> DataFrame:
    """X5 streamed: item totals per window and product over the files of a table of nested orders."""
    return stream_table(spark, path, lambda df: item_window_totals(df, time_col, window, delay), sentinel,
                        name="item-totals-stream", **kw)
