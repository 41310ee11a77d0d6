"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ...).  Only when it is unset *and* the master is local (tests,
benchmarks) do we create one under the system temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every shoplake session wants.  AQE re-plans joins at runtime
# (broadcast when the real build side is small, skew-join splitting of hot
# keys, partition coalescing); the broadcast threshold is the size check that
# guards every dimension join.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # large streaming state lives on local disk (RocksDB), not on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(shuffle_bytes: int, total_cores: int,
               target_partition_bytes: int = 128 * 1024 * 1024,
               max_partitions: int = 100_000) -> dict:
    """Shuffle and scan sizing for a cluster run.

    ``shuffle_bytes`` is the largest shuffle a job writes (after pruning and
    partial aggregation; at most the input size).  The initial shuffle
    partition count makes such a partition about ``target_partition_bytes``,
    with at least three waves of tasks and at most ``max_partitions`` (map
    output tracking grows with mappers x reducers); AQE then coalesces small
    partitions toward the advisory size and splits skewed join partitions.
    Scans read ``maxPartitionBytes`` per task.
    """
    by_size = -(-shuffle_bytes // target_partition_bytes)
    partitions = min(max_partitions, max(3 * total_cores, by_size))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "shoplake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    # one JVM: "local" or "local[...]", not "local-cluster[...]", whose executors are processes of their own
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """Return (and lazily create) a folder every executor can read and write.

    Reads ``spark.checkpoint.dir`` from the session.  If unset on a local
    master, a folder is made and registered as the checkpoint dir; on a
    cluster an unset value is an error rather than a silent node-local path.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")
        base = tempfile.mkdtemp(prefix="shoplake-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # core conf may be read-only at runtime
            pass
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    if name is None:
        return base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def parts_for(rows: int, per_part: int, least: int = 8) -> int:
    """Blocks or partitions for so many rows; the same for the same data on any cluster."""
    return max(least, -(-rows // per_part))


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder under the shared directory and read it back.

    Later jobs read the files: a lost executor never makes Spark redo the work
    above, and a join of two such tables has bare scans on both sides, so AQE
    can split a hot key.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
