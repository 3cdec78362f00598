"""Logs of messages: offset vectors, marks, and jobs that start by them."""

import json

import pytest
from pyspark.sql import functions as F

from rowrelay import KafkaLog, MessageFiles, Options, Table, run_batch, run_job, start_stream
from rowrelay.functions.offsets import Offsets, end_of, is_from
from rowrelay.functions.record import decode, encode, parse
from rowrelay.operators.replay import replay
from rowrelay.plans.job import start_mark
from rowrelay.plans.tablelog import IMAGE, change_log, wire_log
from rowrelay.sinks.targets import files
from rowrelay.sources.changelog import stream_text
from rowrelay.sources.logs import MESSAGE


def record(number, status, op="u"):
    image = {"id": number, "status": status, "price": 1.0}
    source = {"db": "app", "table": "t", "file": "binlog.000001", "pos": number, "row": 0, "ts_ms": 1}
    return json.dumps({"before": None, "after": image, "source": source, "op": op, "ts_ms": 1, "transaction": None})


def messages(spark, path, *rows):
    frame = spark.createDataFrame([(t, p, o, None if v is None else bytearray(v, "utf-8")) for t, p, o, v in rows], MESSAGE)
    frame.write.mode("append").parquet(path)


def run(spark, log, opts, out, tables=None):
    run_job(spark, log, opts, files(out), tables, available_now=True).awaitTermination()
    return sorted((r.op, int(r.row_id), json.loads(r.value)["after"]["status"]) for r in parse(spark.read.text(out)).collect())


def test_vectors_compare_by_partition():
    a, b = Offsets({("t", 0): 5, ("t", 1): 2}), Offsets({("t", 0): 4, ("u", 0): 1})
    assert not a.reaches(b) and not b.reaches(a)
    both = a.joined(b)
    assert both.following == {("t", 0): 5, ("t", 1): 2, ("u", 0): 1}
    assert both.reaches(a) and both.reaches(b) and a.reaches(Offsets())


def test_start_of_a_kafka_reader():
    """Each partition is named; one without a record starts at its first."""
    mark = Offsets({("t", 1): 7})
    assert json.loads(mark.starting({"t": 3, "u": 1})) == {"t": {"0": -2, "1": 7, "2": -2}, "u": {"0": -2}}
    for partitions in ({"u": 1}, {"t": 1}):
        with pytest.raises(ValueError, match="unknown"):
            mark.starting(partitions)


def test_kafka_options():
    log, opts = KafkaLog({"t": 2}, Offsets({("t", 0): 3})), Options(brokers="b:1", start_mode=2, max_batch_records=9)
    assert log.end_options(opts) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": '{"t": {"0": 3, "1": -2}}',
        "endingOffsets": "latest",
    }
    follow = log.follow_options(opts, Offsets({("t", 1): 4}))
    assert (follow["startingOffsets"], follow["maxOffsetsPerTrigger"]) == ('{"t": {"0": -2, "1": 4}}', "9")
    assert log.follow_options(opts.with_(start_mode=4, start_timestamp=5), None)["startingTimestamp"] == "5"


def test_records_from_a_vector(spark):
    rows = [("t", 0, 4), ("t", 0, 5), ("t", 2, 0), ("u", 0, 0), (None, 0, 9), ("t", None, 9), ("t", 0, None)]
    frame = spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    kept = frame.where(is_from(Offsets({("t", 0): 5, ("t", 1): 9}))).collect()
    assert {tuple(r) for r in kept} == set(rows) - {("t", 0, 4)}
    assert frame.where(is_from(Offsets())).count() == len(rows)
    assert end_of(frame.where("offset < 9 AND topic = 't'")).following == {("t", 0): 6, ("t", 2): 1}
    assert end_of(frame.where("false")) == Offsets()


def test_only_offsets_are_read_for_the_end(spark, tmp_path):
    path = str(tmp_path / "log")
    messages(spark, path, ("t", 0, 1, "{}"))
    plan = spark.read.schema(MESSAGE).parquet(path).groupBy("topic", "partition").agg(F.max("offset"))
    assert "value" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", [0, 2])
def test_job_over_messages(spark, tmp_path, mode):
    """The mark is taken once and stays; older messages in later files, and tombstones, are left out."""
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    opts = Options(job_id="j", start_mode=mode, checkpoint_dir=str(tmp_path / "job"))
    old = [("t", 0, 10, record(1, "old")), ("t", 1, 3, record(2, "old"))]
    messages(spark, path, *old)
    rows = spark.createDataFrame([(1, "old", 1.0), (2, "old", 1.0)], "id bigint, status string, price double")
    tables = {"app.t": Table(rows)}
    taken = [("r", 1, "old"), ("r", 2, "old")] if mode == 0 else []
    if taken:
        assert run(spark, MessageFiles(path), opts, out, tables) == taken
    else:
        run_job(spark, MessageFiles(path), opts, files(out), available_now=True).awaitTermination()
    messages(spark, path, *old, ("t", 0, 11, record(1, "new")), ("t", 1, 4, None), ("t", 2, 0, record(3, "new", "c")))
    found = run(spark, MessageFiles(path), opts, out, tables)
    assert found == sorted([*taken, ("u", 1, "new"), ("c", 3, "new")])
    assert run(spark, MessageFiles(path), opts, out, tables) == found
    assert start_mark(spark, MessageFiles(path), opts, f"{opts.checkpoint_dir}/j").following == {("t", 0): 11, ("t", 1): 4}
    if taken:
        state = replay(decode(spark.read.text(out).select("value"), IMAGE)).select("after.*")
        assert sorted(map(tuple, state.collect())) == [(1, "new", 1.0), (2, "old", 1.0), (3, "new", 1.0)]


def test_job_over_an_empty_log(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    spark.createDataFrame([], MESSAGE).write.parquet(path)
    opts = Options(job_id="j", start_mode=2, checkpoint_dir=str(tmp_path / "job"))
    run_job(spark, MessageFiles(path), opts, files(out), available_now=True).awaitTermination()
    messages(spark, path, ("t", 0, 0, record(1, "new")))
    assert run(spark, MessageFiles(path), opts, out) == [("u", 1, "new")]


def test_a_latest_start_needs_its_mark(spark, small, tmp_path):
    source, opts = str(tmp_path / "log"), Options(job_id="j", start_mode=2, checkpoint_dir=str(tmp_path / "job"))
    encode(change_log(spark, small)).limit(3).write.text(source)
    with pytest.raises(ValueError, match="start_after"):
        run_batch(wire_log(spark, small), opts, files(str(tmp_path / "out")))
    with pytest.raises(ValueError, match="start_after"):
        start_stream(stream_text(spark, source, opts), opts, files(str(tmp_path / "out")))
