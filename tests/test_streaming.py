"""Streaming traces (FIXTURES.md section 4) through a JSON file stream."""

import json
import os
import tempfile
import time

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from shoplake.streaming import io as sio
from shoplake.streaming.windows import behavior_uv_pv, explode_order_items, order_window_totals

SCHEMA = StructType([StructField("user_id", LongType()), StructField("behavior_type", StringType()),
                     StructField("behavior_time", TimestampType())])


def _write_batches(folder, batches):
    base = time.time() - 1000
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            for sec, user, beh in rows:
                ts = f"2024-01-01 00:{sec // 60:02d}:{sec % 60:02d}"
                f.write(json.dumps({"user_id": user, "behavior_type": beh, "behavior_time": ts}) + "\n")
        os.utime(path, (base + i * 10, base + i * 10))


def _run(spark, batches, progress=None):
    root = tempfile.mkdtemp(prefix="shoplake-stream-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    _write_batches(src, batches)
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").json(src))
    result = behavior_uv_pv(stream, delay="5 seconds")
    q = sio.start_file_sink(result, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                            fmt="json", available_now=True)
    q.awaitTermination()
    dropped = sio.dropped_late_rows(q)
    if progress is not None:
        progress.extend(q.recentProgress)
    out = spark.read.schema("window_start timestamp, behavior_type string, uv long, pv long") \
        .json(os.path.join(root, "out"))
    rows = sorted((r.window_start.strftime("%H:%M"), r.behavior_type, r.uv, r.pv)
                  for r in out.collect())
    return rows, dropped


def test_trace_one_late_row_still_counted(spark):
    v, b = "view", "buy"
    progress = []
    rows, dropped = _run(spark, progress=progress, batches=[
        [(1, 1, v), (2, 1, v), (3, 2, v), (4, None, v), (30, 3, b)],
        [(66, 1, v), (50, 9, v)],
        [(10, 8, v), (130, 1, v)],
        [(300, 1, b)],
    ])
    assert rows == [("00:00", b, 1, 1), ("00:00", v, 4, 6), ("00:01", v, 1, 1), ("00:02", v, 1, 1)]
    assert dropped == 0
    # closed windows are evicted: only the open 00:05 window is left in each state store
    last = progress[-1]["stateOperators"]
    assert sorted(op["numRowsTotal"] for op in last) == [0, 1]


def test_trace_two_late_row_dropped(spark):
    v, b = "view", "buy"
    rows, dropped = _run(spark, [
        [(1, 1, v), (2, 1, v)],
        [(66, 1, v), (50, 9, v)],
        [(130, 1, v)],
        [(10, 8, v), (300, 1, b)],
        [(400, 1, b)],
    ])
    assert rows == [("00:00", v, 2, 3), ("00:01", v, 1, 1), ("00:02", v, 1, 1), ("00:05", b, 1, 1)]
    assert dropped == 1


def test_parse_and_order_totals(spark):
    raw = spark.createDataFrame([
        ('{"order_id": 1, "user_id": 3, "order_status": "cancelled", "actual_amount": 10.5, '
         '"order_time": "2024-01-01 00:00:10", "items": [{"product_id": 7, "quantity": 2, '
         '"unit_price": 1.5, "subtotal": 3.0}, {"product_id": 8, "quantity": 1, '
         '"unit_price": 7.5, "subtotal": 7.5}]}',),
        ('{"order_id": 2, "user_id": 4, "order_status": "paid", "actual_amount": 4.5, '
         '"order_time": "2024-01-01 00:00:50", "items": []}',),
        ("not json",)], "value string")
    parsed = sio.parse_orders(raw)
    assert parsed.where("order_id is null").count() == 1
    tot = order_window_totals(parsed.where("order_id is not null")).collect()
    assert [(r.order_count, r.total_amount, r.avg_amount) for r in tot] == [(2, 15.0, 7.5)]
    paid = order_window_totals(parsed.where("order_id is not null"), statuses=["paid"]).first()
    assert paid.order_count == 1
    items = explode_order_items(parsed.where("order_id = 1"))
    assert sorted(r.product_id for r in items.collect()) == [7, 8]


EVENT_SENTINEL = {"ts": sio.SENTINEL_TIME, "event_type": "~sentinel"}


def test_table_stream_equals_batch_twin(spark):
    from shoplake.sources import bindings as B
    from conftest import SF_SMALL
    got = sio.stream_uv_pv(spark, B.table_path(SF_SMALL, "events"), B.bind_events, EVENT_SENTINEL)
    batch = behavior_uv_pv(B.user_behavior(spark, SF_SMALL))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_table_stream_in_several_micro_batches_writes_one_row(spark, tmp_path):
    from pyspark.sql import functions as F
    from shoplake.sources import bindings as B
    from conftest import SF_SMALL
    src = str(tmp_path / "events")
    ev = B.read_table(spark, SF_SMALL, "events")
    cuts = ev.selectExpr("percentile_approx(unix_micros(cast(ts as timestamp)), array(0.34, 0.67))").first()[0]
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    for lo, hi in zip([-1 << 62, *cuts], [*cuts, 1 << 62]):      # files in event-time order
        ev.where((us >= lo) & (us < hi)).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)                                          # the source orders files by modification time
    work = str(tmp_path / "work")
    got = sio.stream_uv_pv(spark, src, B.bind_events, EVENT_SENTINEL, max_files_per_trigger=1, work_dir=work)
    batch = behavior_uv_pv(B.user_behavior(spark, SF_SMALL))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert len(os.listdir(f"{work}/checkpoint/commits")) >= 4
    assert spark.read.parquet(f"{work}/sentinel").count() == 1
    assert sorted(os.listdir(work)) == ["checkpoint", "output", "sentinel"]


def test_json_lines_stream_order_totals(spark):
    root = tempfile.mkdtemp(prefix="shoplake-orders-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    base = time.time() - 1000
    batches = [[(1, 10, "paid", 5.0), (2, 40, "cancelled", 7.0)],
               [(3, 70, "paid", 1.0)],
               [(4, 200, "paid", 2.0)]]
    for i, rows in enumerate(batches):
        path = os.path.join(src, f"o-{i}.json")
        with open(path, "w") as f:
            for oid, sec, st, amt in rows:
                f.write(json.dumps({"order_id": oid, "user_id": 1, "order_status": st,
                                    "actual_amount": amt,
                                    "order_time": f"2024-01-01 00:{sec // 60:02d}:{sec % 60:02d}",
                                    "items": []}) + "\n")
        os.utime(path, (base + i * 10, base + i * 10))
    parsed = sio.parse_orders(sio.json_lines_stream(spark, src, max_files_per_trigger=1))
    totals = order_window_totals(parsed, delay="5 seconds")
    q = sio.start_file_sink(totals, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                            fmt="json", available_now=True)
    q.awaitTermination()
    out = spark.read.schema("window_start timestamp, window_end timestamp, order_count long, "
                            "total_amount double, avg_amount double").json(os.path.join(root, "out"))
    got = sorted((r.window_start.strftime("%H:%M"), r.order_count, r.total_amount)
                 for r in out.collect())
    # the 00:03 window stays open (nothing moves the watermark past 00:04)
    assert got == [("00:00", 2, 12.0), ("00:01", 1, 1.0)]


def test_live_behavior_job_over_json_lines(spark):
    from shoplake.streaming import jobs as sjobs
    root = tempfile.mkdtemp(prefix="shoplake-live-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    base = time.time() - 1000
    batches = [[(1, 1, "view"), (2, 2, "view"), (3, 1, "cart")], [(70, 3, "view")], [(200, 1, "buy")]]
    for i, rows in enumerate(batches):
        path = os.path.join(src, f"b-{i}.json")
        with open(path, "w") as f:
            for sec, user, beh in rows:
                f.write(json.dumps({"log_id": sec, "user_id": user, "product_id": 5,
                                    "behavior_type": beh, "session_id": "s", "ip": "1.1.1.1",
                                    "behavior_time": f"2024-01-01 00:{sec // 60:02d}:{sec % 60:02d}"})
                        + "\n")
        os.utime(path, (base + i * 10, base + i * 10))
    raw = sio.json_lines_stream(spark, src, max_files_per_trigger=1)
    q = sjobs.start_behavior_uv_pv(raw, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                                   available_now=True)
    q.awaitTermination()
    out = spark.read.schema("window_start timestamp, behavior_type string, uv long, pv long") \
        .json(os.path.join(root, "out"))
    got = sorted((r.window_start.strftime("%H:%M"), r.behavior_type, r.uv, r.pv) for r in out.collect())
    assert got == [("00:00", "cart", 1, 1), ("00:00", "view", 2, 2), ("00:01", "view", 1, 1)]


def test_connector_options():
    from shoplake.sources import jdbc
    o = jdbc.jdbc_options("jdbc:mysql://db/shop", jdbc.SOURCE_QUERIES["fact_order"], "order_id",
                          1, 5000, 3, user="u")
    assert jdbc.bounds_query("SELECT a FROM t", "a") == "SELECT MIN(a) AS lo, MAX(a) AS hi, COUNT(*) AS n FROM (SELECT a FROM t) q"
    assert (jdbc.partitions_for(0, 10), jdbc.partitions_for(10, 10), jdbc.partitions_for(11, 10)) == (1, 1, 2)
    assert o["dbtable"].startswith("(SELECT order_id") and o["dbtable"].endswith(") t")
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == \
        ("order_id", "1", "5000", "3")
    assert o["user"] == "u" and "password" not in o
    assert "DATE_FORMAT(create_time, '%Y-%m-%d %H:%i:%s')" in o["dbtable"] and "{" not in o["dbtable"]
    k = sio.kafka_options("b1:9092,b2:9092", sio.BEHAVIOR_TOPIC, group_id="g",
                          max_offsets_per_trigger=100000)
    assert k == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "user-behavior-log",
                 "startingOffsets": "latest", "kafka.group.id": "g",
                 "maxOffsetsPerTrigger": "100000"}


def test_order_totals_stream_with_status_filter(spark):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from shoplake.sources import bindings as B
    o = B.fact_order(spark, SF_SMALL)
    got = sorted(tuple(r) for r in sio.stream_order_totals(
        spark, B.table_path(SF_SMALL, "orders"), B.bind_orders, {"o_orderdate": sio.SENTINEL_TIME, "o_orderstatus": "O"},
        statuses=["paid"]).collect())
    want = sorted(tuple(r) for r in order_window_totals(o, statuses=["paid"]).collect())
    assert got == want and len(want) > 0
    assert o.where(F.col("order_status") == "paid").count() == sum(r[2] for r in want)


def test_table_stream_of_empty_table(spark, tmp_path):
    from conftest import SF_SMALL
    from shoplake.sources import bindings as B
    B.read_table(spark, SF_SMALL, "events").where("event_id < 0").write.parquet(str(tmp_path / "events"))
    assert sio.stream_uv_pv(spark, str(tmp_path / "events"), B.bind_events, EVENT_SENTINEL).count() == 0


def test_live_order_totals_job(spark):
    from shoplake.streaming import jobs as sjobs
    root = tempfile.mkdtemp(prefix="shoplake-live-orders-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    base = time.time() - 1000
    for i, rows in enumerate([[(1, 5, 10.0), (2, 20, 2.5)], [(3, 200, 1.0)]]):
        path = os.path.join(src, f"o-{i}.json")
        with open(path, "w") as f:
            for oid, sec, amt in rows:
                f.write(json.dumps({"order_id": oid, "user_id": 7, "order_status": "paid",
                                    "actual_amount": amt, "items": [],
                                    "order_time": f"2024-01-01 00:{sec // 60:02d}:{sec % 60:02d}"})
                        + "\n")
        os.utime(path, (base + i * 10, base + i * 10))
    q = sjobs.start_order_totals(sio.json_lines_stream(spark, src, max_files_per_trigger=1),
                                 os.path.join(root, "out"), os.path.join(root, "ckpt"),
                                 available_now=True)
    q.awaitTermination()
    out = spark.read.schema("window_start timestamp, window_end timestamp, order_count long, "
                            "total_amount double, avg_amount double").json(os.path.join(root, "out"))
    assert [(r.order_count, r.total_amount, r.avg_amount) for r in out.collect()] == [(2, 12.5, 6.25)]


def test_register_views(spark):
    from conftest import SF_SMALL
    from shoplake.sources import bindings as B
    from shoplake.sources import snapshot
    snapshot.register_views(B.business_tables(spark, SF_SMALL))
    n = spark.sql("SELECT COUNT(*) AS n FROM fact_order WHERE order_status = 'paid'").first().n
    assert n == B.fact_order(spark, SF_SMALL).where("order_status = 'paid'").count()


def test_ntz_wall_times_ignore_the_session_zone(spark):
    from pyspark.sql import functions as F

    from shoplake.sources import snapshot
    from shoplake.streaming.windows import instant_to_ntz, ntz_to_instant
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")  # 1995-10-15 00:00 is skipped
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'1995-10-15 00:00:00' AS order_time, "
                       "CAST(1 AS DOUBLE) AS actual_amount, 'paid' AS order_status")
        assert snapshot.snapshot_project(df).first().order_time == "1995-10-15 00:00:00"
        back = df.select(instant_to_ntz(ntz_to_instant(F.col("order_time"))).alias("t")).first().t
        assert back.isoformat() == "1995-10-15T00:00:00"
        w = order_window_totals(df, delay="5 seconds").first()   # the streaming conversion path
        assert w.window_start.isoformat() == "1995-10-15T00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_restart_keeps_watermark_and_state(spark):
    """Stop and restart on one checkpoint: the watermark survives, a late row after the
    restart is dropped, and windows closed before the restart are not emitted twice."""
    root = tempfile.mkdtemp(prefix="shoplake-restart-")
    src, out, ckpt = (os.path.join(root, n) for n in ("src", "out", "ckpt"))
    os.makedirs(src)

    def put(i, rows):
        path = os.path.join(src, f"part-{i:03d}.json")
        with open(path, "w") as f:
            for sec, user, beh in rows:
                f.write(json.dumps({"user_id": user, "behavior_type": beh,
                                    "behavior_time": f"2024-01-01 00:{sec // 60:02d}:{sec % 60:02d}"})
                        + "\n")
        os.utime(path, (time.time() - 1000 + i * 10,) * 2)

    def run():
        stream = (spark.readStream.schema(SCHEMA).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
                  .json(src))
        q = sio.start_file_sink(behavior_uv_pv(stream, delay="5 seconds"), out, ckpt,
                                fmt="json", available_now=True)
        q.awaitTermination()
        return sio.dropped_late_rows(q)

    put(0, [(1, 1, "view"), (2, 2, "view"), (70, 1, "view")])
    assert run() == 0                                    # watermark now 65 s: 00:00 closes
    put(1, [(10, 3, "view"), (130, 1, "view")])          # the 10 s row is late after restart
    assert run() == 1
    rows = sorted((r.window_start.strftime("%H:%M"), r.uv, r.pv) for r in spark.read.schema(
        "window_start timestamp, behavior_type string, uv long, pv long").json(out).collect())
    assert rows == [("00:00", 2, 2), ("00:01", 1, 1)]
