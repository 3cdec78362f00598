"""Time the main jobs and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the cores. Before timing,
the change log is written as text and the tables are written in as many files as
tasks need; a table of one file with one row group would be read by one task.
A plan is built once and run to the ``noop`` sink; the jobs with files in their
name, and diff_applied, are built and run each time. Each time is the median of ``BENCH_RUNS`` runs
after one warm-up. ``BENCH_ONLY`` may list the jobs to run.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay import Options, deliveries, run_batch, start_stream
from rowrelay.functions.record import decode, encode
from rowrelay.operators import capture
from rowrelay.operators.convert import convert_row
from rowrelay.plans.orders import ORDER_TYPES, order_rows
from rowrelay.operators.replay import apply_changes, replay
from rowrelay.operators.routing import fanout_counts
from rowrelay.plans.tablelog import IMAGE, drawn_orders, order_versions, wire_log
from rowrelay.sinks.targets import files
from rowrelay.sources.changelog import read_text, stream_text
from rowrelay.sources.tables import read_parquet
from rowrelay.streaming.folders import new_folder

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
ONLY = os.environ.get("BENCH_ONLY", "").split()

OPTS = Options(partitions=4)
MARK = capture.Position(1, 30000)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("rowrelay-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def typed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a column for every conversion rule."""
    shipped = F.col("l_shipdate")
    return read_parquet(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("price"),
        F.col("l_partkey").cast("decimal(20,0)").alias("part"),
        shipped.cast("date").alias("day"),
        shipped.alias("moment"),
        F.timestamp_add("SECOND", F.col("l_partkey"), shipped).alias("instant"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber"), F.col("l_quantity")).alias("clock"),
        F.col("l_returnflag").alias("flag"),
    )


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    declared = {"part": "bigint unsigned", "instant": "timestamp"}
    rows = convert_row(typed_rows(spark, folder), declared, zone="Asia/Shanghai")
    return encode(capture.snapshot(rows, "test", "tb_item", mark=MARK))


def main() -> None:
    spark = session()
    log = new_folder(spark, "bench-log")
    wire_log(spark, FOLDER).repartition(CPUS * 2).write.text(log)
    wire = read_text(spark, log)
    staged = new_folder(spark, "bench-tables")
    for table in ("lineitem", "orders"):
        rows = read_parquet(spark, FOLDER, table).repartition(CPUS * 2)
        rows.write.parquet(f"{staged}/{table}.parquet")
    old, new = order_versions(spark, staged)
    orders = order_rows(drawn_orders(spark, staged))
    counts = {
        "records": wire.count(),
        "rows": read_parquet(spark, FOLDER, "lineitem").count(),
        "orders": read_parquet(spark, FOLDER, "orders").count(),
    }

    def noop(frame: DataFrame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    def fan_out(order: str) -> None:
        run_batch(wire, OPTS.with_(order=order), files(new_folder(spark, "bench-out"), by_partition=True))

    def stream() -> None:
        opts = OPTS.with_(job_id="bench", checkpoint_dir=new_folder(spark, "bench-job"))
        target = files(new_folder(spark, "bench-out"))
        start_stream(stream_text(spark, log, opts), opts, target, available_now=True).awaitTermination()

    def full_snapshot() -> DataFrame:
        rows = convert_row(orders, ORDER_TYPES, zone="Asia/Shanghai")
        return capture.snapshot(rows, "test", "tb_order", mark=MARK)

    def difference() -> DataFrame:
        return capture.diff(old, new, ["id"], "test", "tb_order", mark=MARK)

    filtered = OPTS.with_(databases="test", tables=r"test\.tb_.*")
    plans = {
        "route": ("records", deliveries(wire, OPTS)),
        "route_filtered": ("records", deliveries(wire, filtered)),
        "fanout_counts": ("records", fanout_counts(deliveries(wire, OPTS))),
        "encode": ("rows", encoded(spark, staged)),
        "encode_orders": ("orders", encode(full_snapshot())),
        "table_diff": ("orders", difference()),
        "replay": ("records", replay(decode(wire, IMAGE))),
    }
    jobs = {name: (unit, partial(noop, frame)) for name, (unit, frame) in plans.items()}
    for order in ("none", "gathered", "partition"):
        jobs[f"files_{order}"] = ("records", partial(fan_out, order))
    jobs["stream_files"] = ("records", stream)
    # The changes are written when this is called, so building belongs to the time.
    jobs["diff_applied"] = ("orders", lambda: noop(apply_changes(old, difference(), ["id"], "test", "tb_order")))
    jobs = {name: job for name, job in jobs.items() if not ONLY or name in ONLY}
    times = {}
    for name, (_, run) in jobs.items():
        run()
        samples = []
        for _ in range(RUNS):
            began = time.perf_counter()
            run()
            samples.append(time.perf_counter() - began)
        times[name] = round(statistics.median(samples), 4)
    result = {
        "metric": "total_median_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "per_second": {name: round(counts[unit] / times[name]) for name, (unit, _) in jobs.items()},
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "runs": RUNS,
        "spark": spark.version,
        "input": counts,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
