"""Full-snapshot lake I/O and catalog registration.

Snapshots live in ``<root>/<table>/full/<snapshot_date>`` (a refresh writes a
version beside it and then names it in a manifest, see ``commits``) as tab-separated
text without quoting and with ``\\N`` for NULL, read with a fixed schema.
Parquet is the default for new lakes (``fmt="parquet"``): it carries types
and lets Catalyst push filters and prune columns into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, StructType, TimestampNTZType,
                               TimestampType)

from shoplake.functions.labels import LAKE_DATETIME_FORMAT
from shoplake.schemas import TABLES
from shoplake.sources import commits

TSV_OPTIONS = {"sep": "\t", "quote": "", "escape": "", "nullValue": "\\N", "header": "false",
               "mode": "PERMISSIVE"}
DATETIME_FORMAT = LAKE_DATETIME_FORMAT


def snapshot_path(root: str, table: str, snapshot_date: str) -> str:
    return f"{root.rstrip('/')}/{table}/full/{snapshot_date}"


def read_snapshot(spark: SparkSession, root: str, table: str, snapshot_date: str,
                  schema: StructType | None = None, fmt: str = "tsv") -> DataFrame:
    """One dated snapshot with its fixed schema."""
    path = commits.resolve(spark, snapshot_path(root, table, snapshot_date))
    schema = schema or TABLES[table]
    if fmt == "tsv":
        return spark.read.schema(schema).options(**TSV_OPTIONS).csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


CORRUPT = "_corrupt"


def read_snapshot_checked(spark: SparkSession, root: str, table: str, snapshot_date: str,
                          schema: StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of a TSV snapshot that parse, and those that do not.

    A line with a field that its type cannot hold, or with too few or too many
    fields, would read as NULLs.  Here the first frame holds only lines that
    parse whole, with the columns of the schema; the second the others:
    ``line``, ``file``, ``block`` (start of the file block).  Together they are
    all lines; a blank one is among the others.  An empty field and the NULL mark parse as NULL.
    """
    path = commits.resolve(spark, snapshot_path(root, table, snapshot_date))
    schema = schema or TABLES[table]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + f", `{CORRUPT}` string"
    # parsed as an expression over the lines: a CSV scan prunes columns, and with a column its errors
    lines = spark.read.text(path).select(
        F.from_csv("value", F.lit(ddl), dict(TSV_OPTIONS, columnNameOfCorruptRecord=CORRUPT)).alias("row"),
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    failed = F.col(f"row.{CORRUPT}").isNotNull() | (F.col("value") == "")
    good = lines.where(~failed).select(*[F.col(f"row.`{f.name}`") for f in schema.fields])
    return good, lines.where(failed).select(F.col("value").alias("line"), "file", "block")


def snapshot_exists(spark: SparkSession, root: str, table: str, snapshot_date: str) -> bool:
    """Whether the dated snapshot is there, asked of the file system that holds it."""
    return commits.published(spark, snapshot_path(root, table, snapshot_date))


def lake_tables(spark: SparkSession, root: str, snapshot_date: str, fmt: str = "tsv",
                optional: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The business tables from one snapshot date (input for ``run_job``); S9: absent ``optional`` ones are left out."""
    return {t: read_snapshot(spark, root, t, snapshot_date, fmt=fmt) for t in TABLES
            if t not in optional or snapshot_exists(spark, root, t, snapshot_date)}


def snapshot_project(df: DataFrame, datetime_format: str = DATETIME_FORMAT,
                     money_as_double: bool = True) -> DataFrame:
    """project to lake types: datetimes as text, DECIMAL money as DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if money_as_double and isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
            continue
        if isinstance(f.dataType, TimestampNTZType) and datetime_format == LAKE_DATETIME_FORMAT:
            # the text of a wall time, free of the session time zone (date_format
            # would shift wall times that a DST change skips)
            cols.append(F.substring(F.col(f.name).cast("string"), 1, 19).alias(f.name))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), datetime_format).alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_snapshot(df: DataFrame, root: str, table: str, snapshot_date: str,
                   fmt: str = "tsv") -> str:
    """K1: replace the dated snapshot (full refresh, parallel writers); returns the folder of the new version.

    The old version stays readable until the new one is complete, also if the job dies (see ``commits``).
    """
    rows = snapshot_project(df)

    def write(folder: str) -> None:
        if fmt == "tsv":
            rows.write.options(**{k: v for k, v in TSV_OPTIONS.items() if k != "mode"}).csv(folder)
        else:
            rows.write.format(fmt).save(folder)
    return commits.refresh(df.sparkSession, snapshot_path(root, table, snapshot_date), write)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally at a location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def use_database(spark: SparkSession, name: str) -> None:
    """``USE <database>``."""
    spark.catalog.setCurrentDatabase(name)


def register_snapshot(spark: SparkSession, database: str, table: str, path: str,
                      schema: StructType | None = None, fmt: str = "tsv") -> str:
    """(re)define an external table over a snapshot path."""
    schema = schema or TABLES[table]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    full = f"`{database}`.`{table}`"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    if fmt == "tsv":
        opts = ", ".join(f"'{k}' '{v}'" for k, v in TSV_OPTIONS.items() if k != "mode")
        spark.sql(f"CREATE TABLE {full} ({cols}) USING csv OPTIONS ({opts}) LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE {full} ({cols}) USING {fmt} LOCATION '{path}'")
    return f"{database}.{table}"


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Temp views for a set of frames (a catalog without a metastore)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``SHOW TABLES``."""
    return spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table if it exists, else None (the caller picks the fallback)."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_catalog_table(spark: SparkSession, name: str, columns=None, where: str | None = None) -> DataFrame:
    """S7 + S8: catalog table scan, column-pruned and filtered (pushed to the scan)."""
    df = spark.table(name)
    if columns:
        df = df.select(*columns)
    return df.where(where) if where else df


def save_bucketed(df: DataFrame, table: str, key: str, num_buckets: int, path: str,
                  fmt: str = "parquet") -> str:
    """Write a fact table bucketed (and sorted) by its join key.

    Two tables bucketed the same way on ``order_id`` (orders and order lines)
    join without a shuffle; the buckets are computed once, at write time.
    Trade-off: a bucketed join has no shuffle for AQE to split, so a key that
    holds a large share of the rows makes one bucket (one task) that large.
    Bucket only on keys without such hot values; otherwise keep the shuffled
    join, where AQE splits skewed partitions.
    """
    (df.write.mode("overwrite").format(fmt).bucketBy(num_buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return table
