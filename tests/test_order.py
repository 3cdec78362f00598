"""Order inside topic partitions, and the sample table's rules."""

import glob

import pytest
from pyspark.sql import functions as F

from rowrelay import Options, deliveries, run_batch
from rowrelay.functions.position import position_order
from rowrelay.functions.record import parse
from rowrelay.operators import ordering
from rowrelay.operators.ordering import exclusive_order, gather, narrow, range_order, spread
from rowrelay.plans.queries import order_projection
from rowrelay.plans.session import cluster_conf
from rowrelay.plans.tablelog import wire_log
from rowrelay.sinks.targets import files, kafka
from rowrelay.sources.changelog import read_delivered
from rowrelay.streaming.folders import names_in, session_folder

OPTS = Options(partitions=4, order="partition")


def routed(spark, folder):
    return deliveries(wire_log(spark, folder), OPTS)


def layout(frame):
    """For each task: the (topic, partition, position) of its rows, in order."""
    placed = frame.select(
        F.spark_partition_id().alias("task"), "topic", "partition", *[c.alias(n) for c, n in zip(position_order(""), "spr")]
    )
    tasks = {}
    for row in placed.collect():
        tasks.setdefault(row.task, []).append(tuple(row)[1:])
    return [tasks[t] for t in sorted(tasks)]


def test_exclusive_order(spark, small):
    tasks = layout(exclusive_order(routed(spark, small), 6))
    for rows in tasks:
        assert rows == sorted(rows)
    groups = [g for rows in tasks for g in {r[:2] for r in rows}]
    assert len(groups) == len(set(groups))


def test_range_order_splits_a_heavy_partition(spark, small):
    tasks = layout(range_order(routed(spark, small), 16))
    rows = [r for task in tasks for r in task]
    assert len(rows) == routed(spark, small).count()
    assert rows == sorted(rows)
    heavy = ("mysqlbinlog_test_tb_order", 0)
    assert sum(any(r[:2] == heavy for r in task) for task in tasks) > 1
    assert max(map(len, tasks)) < len(rows) / 4


@pytest.mark.parametrize("value", ["CAST(id AS STRING)", "'copy'"])
def test_range_order_splits_records_of_one_position(spark, value):
    """Snapshot rows share their position, copies their text too, and still spread."""
    frame = spark.range(20000).selectExpr(
        "'t' AS topic", "0 AS partition", "'bin.1' AS file", "1L AS pos", "0 AS row", f"{value} AS value"
    )
    sizes = [len(task) for task in layout(range_order(frame, 8))]
    assert sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) < 6000


def test_ordered_files(spark, small, tmp_path):
    """Files in name order hold each topic partition in log order, and nothing is lost."""
    out = str(tmp_path / "out")
    run_batch(wire_log(spark, small), OPTS.with_(sink_parallelism=5), files(out, by_partition=True))
    wanted = {}
    for r in routed(spark, small).select("topic", "partition", "value", *[c.alias(n) for c, n in zip(position_order(""), "spr")]).collect():
        wanted.setdefault((r.topic, r.partition), []).append((r.s, r.p, r.r, r.value))
    found = {}
    for name in sorted(glob.glob(f"{out}/*/*/part-*")):
        topic, partition = (p.split("=")[1] for p in name.split("/")[-3:-1])
        found.setdefault((topic, int(partition)), []).extend(open(name, encoding="utf-8").read().splitlines())
    assert found == {k: [v[3] for v in sorted(rows)] for k, rows in wanted.items()}


def test_unordered_batch_delivery(spark, small, tmp_path):
    out = str(tmp_path / "out")
    run_batch(wire_log(spark, small), Options(sink_parallelism=3), files(out))
    assert spark.read.text(out).count() == wire_log(spark, small).count()
    assert len({n.split("/part-")[1][:5] for n in glob.glob(f"{out}/*/part-*")}) <= 3


def test_gathered_files(spark, small, tmp_path):
    """One file for each light topic partition instead of one per task."""
    wire, counts = wire_log(spark, small).repartition(12), {}
    for order in ("none", "gathered"):
        out = str(tmp_path / order)
        run_batch(wire, Options(partitions=4, order=order), files(out, by_partition=True))
        assert spark.read.text(out).count() == wire.count()
        counts[order] = len(glob.glob(f"{out}/*/*/part-*"))
    assert counts["gathered"] == 9 < counts["none"]


def test_gathering_cuts_a_heavy_partition(spark):
    """A topic partition with most of the data is spread over several tasks."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "2m")
        rows = spark.range(0, 400000, 1, 8).selectExpr(
            "IF(id % 10 = 0, 'light', 'heavy') AS topic", "0 AS partition", "sha2(CAST(id AS STRING), 256) AS value"
        )
        placed = gather(rows).withColumn("task", F.spark_partition_id())
        tasks = placed.groupBy("topic", "task").agg(F.count("value").alias("n"), F.max("value")).collect()
    finally:
        spark.conf.set(size, before)
    assert sum(r.n for r in tasks) == 400000
    assert len({r.task for r in tasks if r.topic == "heavy"}) > 4


def test_ordered_batch_to_a_live_target_is_refused(spark, small):
    with pytest.raises(ValueError, match="stream"):
        run_batch(wire_log(spark, small), OPTS, kafka(OPTS))


def test_order_rules(spark, small):
    rows = order_projection(spark, small)
    assert rows.where("status < 2 AND (pay_time IS NOT NULL OR updated_time IS NOT NULL)").count() == 0
    assert rows.where("status >= 5 AND updated_time <> send_out_time").count() == 0
    assert rows.where("(finished_time IS NOT NULL) <> (status >= 5)").count() == 0
    assert rows.where("(send_out_time IS NOT NULL) <> (status >= 4)").count() == 0
    assert rows.where("abs(pay_amount - (price * amount - coupon_id % 9 + freight_charge)) > 1e-9").count() == 0


def test_delivered_sequence_of_a_snapshot_and_its_changes(spark, tmp_path):
    """Records without a place in the log come first; null partitions and split files keep all."""
    rows = spark.range(3000).selectExpr(
        "'t' AS topic",
        "IF(id % 2 = 0, 0, NULL) AS partition",
        "CASE WHEN id % 3 = 0 THEN '' ELSE 'bin.2' END AS file",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id * 10 END AS pos",
        "0 AS row",
        "concat(IF(id % 3 = 0, 0, id * 10), ' ', id) AS value",
    )
    out, size = str(tmp_path / "out"), "spark.sql.files.maxPartitionBytes"
    files(out, by_partition=True).write(range_order(rows, 4))
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "2000")
        numbered = read_delivered(spark, out).collect()
    finally:
        spark.conf.set(size, before)
    assert len({r.value for r in numbered}) == 3000
    for partition in (0, None):
        group = sorted((r.sequence, int(r.value.split(" ")[0])) for r in numbered if r.partition == partition)
        assert [n for n, _ in group] == list(range(1500))
        positions = [pos for _, pos in group]
        assert positions == sorted(positions)


def test_order_of_a_constant_topic(spark, small, tmp_path):
    """Routers may give every record the same topic and partition."""
    out = str(tmp_path / "out")
    opts = OPTS.with_(router=lambda db, table: F.lit("all"), partitioner=lambda row_id, count: F.lit(0), databases="test")
    run_batch(wire_log(spark, small).repartition(5), opts, files(out, by_partition=True))
    rows = parse(read_delivered(spark, out), keep=["sequence"], position=True).select("sequence", *[c.alias(n) for c, n in zip(position_order(""), "spr")])
    places = [tuple(r)[1:] for r in rows.orderBy("sequence").collect()]
    assert places == sorted(places) and len(places) == wire_log(spark, small).count() - 150


def test_reading_where_nothing_was_delivered(spark, small, tmp_path):
    out = str(tmp_path / "out")
    run_batch(wire_log(spark, small).where("false"), OPTS, files(out, by_partition=True))
    found = read_delivered(spark, out)
    assert found.columns == ["value", "topic", "partition", "sequence"] and found.count() == 0


def test_narrowing_needs_no_shuffle(spark, small):
    frame = narrow(routed(spark, small).repartition(9), 3)
    assert frame.select(F.spark_partition_id()).distinct().count() == 3
    plan = narrow(routed(spark, small), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Coalesce" in plan


def test_cluster_settings():
    conf = cluster_conf(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // 2**28
    assert int(cluster_conf(10 * 2**30, 100)["spark.sql.shuffle.partitions"]) == 200
    assert int(cluster_conf(2**40, 100)["spark.sql.shuffle.partitions"]) == 4096


def test_more_writers_than_the_input_has_parts(spark, small):
    """One topic partition in one input part goes to all writers, each record to the same one again."""
    frame = routed(spark, small).where("topic = 'mysqlbinlog_test_tb_order' AND partition = 0").coalesce(1)
    placed = [spread(frame, 6).select("value", F.spark_partition_id().alias("w")).collect() for _ in range(2)]
    assert {r.w for r in placed[0]} == set(range(6))
    assert sorted(placed[0]) == sorted(placed[1])
    assert sorted(r.value for r in placed[0]) == sorted(r.value for r in frame.collect())
    assert spread(frame, 2).select(F.spark_partition_id()).distinct().count() == 2


def test_ranges_are_bounded_by_their_bytes(spark, small, tmp_path, monkeypatch):
    """However well the texts shrink, a task sorts little of them; they are parsed once and nothing stays behind."""
    out, bound, parsed = str(tmp_path / "out"), 32 << 10, spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        parsed.add(1)
        return text

    monkeypatch.setattr(ordering, "RANGE", bound)
    wire = wire_log(spark, small)
    size, many = wire.agg(F.sum(F.octet_length("value")), F.count("value")).first()
    run_batch(wire.select(counted("value").alias("value")), OPTS, files(out, by_partition=True, compression="lz4"))
    assert parsed.value == many
    assert not [n for n in names_in(spark, session_folder(spark)) if n.startswith("arrived")]
    tasks = {}
    for row in spark.read.text(out).select(F.regexp_extract(F.col("_metadata.file_path"), r"part-(\d+)", 1).alias("t"), F.octet_length("value").alias("n")).collect():
        tasks[row.t] = tasks.get(row.t, 0) + row.n
    assert sum(tasks.values()) == size > 16 * bound
    assert max(tasks.values()) < 2 * bound


def test_ranges_of_sizes():
    assert [ordering.ranges_of(n, 8) for n in (0, 1, 5 << 20, 30 << 20, 600 << 20, 6000 << 20)] == [1, 1, 2, 8, 10, 94]


def test_numbering_moves_no_texts(spark, small, tmp_path):
    """Parts of several files in a task, cut files and many tasks: places without a shuffle or a sort of the texts."""
    out = str(tmp_path / "out")
    run_batch(wire_log(spark, small), OPTS.with_(sink_parallelism=7), files(out, by_partition=True))
    conf = {"spark.sql.files.maxPartitionBytes": "50000", "spark.sql.files.openCostInBytes": "1000"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        numbered = read_delivered(spark, out)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "row_number" not in plan and "SortMergeJoin" not in plan
        rows = parse(numbered, keep=["topic", "partition", "sequence"], position=True)
        found = sorted((r.topic, r.partition, r.sequence, r.s, r.p, r.r) for r in rows.select("topic", "partition", "sequence", *[c.alias(n) for c, n in zip(position_order(""), "spr")]).collect())
        assert numbered.rdd.getNumPartitions() > 10
    finally:
        for k in conf:
            spark.conf.unset(k)
    groups = {}
    for topic, part, sequence, *place in found:
        groups.setdefault((topic, part), []).append((sequence, place))
    for places in groups.values():
        assert [s for s, _ in places] == list(range(len(places)))
        assert [p for _, p in places] == sorted(p for _, p in places)
