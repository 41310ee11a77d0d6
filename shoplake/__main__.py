"""One-shot job runner (G7): ``python -m shoplake <job> [options]``.

    spark-submit --master yarn shoplake/__main__.py all \\
        --lake hdfs:///lake/ods --date 2026-05-18 --out hdfs:///lake/ads

``<job>`` is etl, user, product, ml or all.  Tables come from a snapshot
lake (``--lake`` + ``--date``) or from TESTDATA parquet (``--testdata``).
The master and cluster settings come from spark-submit; ``--master`` is only
for local runs.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shoplake.plans.jobs import JOBS, run_job
from shoplake.session import DEFAULT_CONF, scale_conf
from shoplake.sources import bindings, snapshot


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="shoplake")
    ap.add_argument("job", choices=sorted(JOBS) + ["all"])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--lake", help="snapshot root (<root>/<table>/full/<date>)")
    src.add_argument("--testdata", help="folder with the TESTDATA parquet tables")
    ap.add_argument("--date", help="snapshot date for --lake")
    ap.add_argument("--format", default="tsv", help="snapshot format (tsv or parquet)")
    ap.add_argument("--out", help="result folder (default: show results)")
    ap.add_argument("--as-of", help="recency reference date (default: today)")
    ap.add_argument("--shuffle-gb", type=float, help="size of the largest shuffle; sets partition counts and sizes")
    ap.add_argument("--cores", type=int, default=8, help="cores of the cluster, with --shuffle-gb")
    ap.add_argument("--master", help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName(f"shoplake-{args.job}")
    if args.master:
        builder = builder.master(args.master)
    conf = dict(DEFAULT_CONF)
    if args.shuffle_gb:
        conf |= scale_conf(int(args.shuffle_gb * (1 << 30)), args.cores)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if args.lake:
        if not args.date:
            ap.error("--lake needs --date")
        tables = snapshot.lake_tables(spark, args.lake, args.date, args.format, optional=("fact_order_detail",))
    else:
        tables = bindings.business_tables(spark, args.testdata)
    written = run_job(spark, args.job, tables, args.out, as_of=args.as_of)
    for name, path in written.items():
        print(f"{name}\t{path}")
    spark.stop()


if __name__ == "__main__":
    main()
