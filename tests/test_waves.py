"""Ordered delivery in waves: several tasks for a topic partition, order, restarts."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rowrelay import Options, job_totals, start_stream, totals
from rowrelay.plans.delivery import progress_columns
from rowrelay.plans.job import Table, run_job
from rowrelay.plans.tablelog import wire_log
from rowrelay.sinks.targets import Target
from rowrelay.sources.changelog import stream_text
from rowrelay.streaming import waves
from rowrelay.streaming.waves import deliver_waves


def table(path):
    place = F.monotonically_increasing_id().alias("place")
    task = F.spark_partition_id().alias("task")
    return Target("parquet", lambda routed: routed.select("topic", "partition", "value", "wave", place, task), {"path": path})


@pytest.fixture
def opts(tmp_path):
    return Options(job_id="w", partitions=2, order="partition", in_waves=True, sink_parallelism=8, checkpoint_dir=str(tmp_path / "jobs"))


@pytest.fixture
def source(spark, small, tmp_path):
    folder = str(tmp_path / "log")
    wire_log(spark, small).repartition(5).write.text(folder)
    return folder


def drain(spark, source, opts, target):
    query = start_stream(stream_text(spark, source, opts), opts, target, available_now=True)
    query.awaitTermination()
    return query


def groups(spark, out):
    """The rows of each topic partition as sent."""
    found = {}
    for r in spark.read.parquet(out).orderBy("wave", "place").collect():
        found.setdefault((r.topic, r.partition), []).append(r)
    return found


def positions(rows):
    found = [json.loads(r.value)["source"] for r in rows]
    return [(s["file"], s["pos"]) for s in found]


def test_a_hot_partition_is_sent_by_several_tasks_in_order(spark, source, opts, tmp_path):
    out = str(tmp_path / "out")
    query = drain(spark, source, opts, table(out))
    found = groups(spark, out)
    assert sum(map(len, found.values())) == 2475 == totals(query)["records"] == len({r.value for rows in found.values() for r in rows})
    for rows in found.values():
        assert positions(rows) == sorted(positions(rows))
        assert len({(r.wave, r.task) for r in rows}) == len({r.wave for r in rows})
    hot = max(found.values(), key=len)
    assert len({r.wave for r in hot}) >= 3
    assert os.listdir(tmp_path / "jobs" / "w" / "waves") == ["0"]
    assert [n for n in os.listdir(tmp_path / "jobs" / "w" / "waves" / "0") if not n.startswith(".")] == ["done"]


class Breaks(Target):
    """Fails after a part of its second write."""

    writes = 0

    def write(self, routed):
        Breaks.writes += 1
        if Breaks.writes == 2:
            super().write(routed.where("partition = 1"))
            raise RuntimeError("lost")
        super().write(routed)


def test_a_restart_goes_on_with_its_wave(spark, source, opts, tmp_path):
    out = str(tmp_path / "out")
    plain, Breaks.writes = table(out), 0
    target = Breaks(plain.format, plain.record, plain.options)
    with pytest.raises(StreamingQueryException):
        drain(spark, source, opts, target)
    assert job_totals(spark, opts) == {}
    before = Breaks.writes
    first = spark.read.parquet(out).where("wave = 0").count()
    drain(spark, source, opts, target)
    rows = spark.read.parquet(out)
    assert rows.where("wave = 0").count() == first
    assert Breaks.writes - before == rows.agg(F.max("wave")).first()[0]
    assert rows.select("value").distinct().count() == 2475 < rows.count()
    assert rows.where("wave <> 1").groupBy("value").count().where("count > 1").count() == 0
    assert job_totals(spark, opts)["records"] == 2475


def routed(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, value string, file string, pos long, row int, op string")


def test_a_batch_is_sent_once_and_earlier_ones_are_forgotten(spark, tmp_path):
    place, got = str(tmp_path / "waves"), []
    rows = [("t" if i % 3 else None, i % 2 if i % 5 else None, f"v{i}", None if i % 7 == 0 else "bin.1", i, 0, "c") for i in range(300)]
    send = lambda frame: got.extend(frame.collect())
    counts = deliver_waves(routed(spark, rows), 0, place, send, progress_columns(), 6)
    assert counts["records"] == 300 and sorted(r.value for r in got) == sorted(r[2] for r in rows)
    for group in {(r.topic, r.partition) for r in got}:
        own = [(r.file is not None, r.pos) for r in got if (r.topic, r.partition) == group]
        assert own == sorted(own)
    assert deliver_waves(routed(spark, rows[:5]), 0, place, send, progress_columns(), 6) == counts and len(got) == 300
    assert deliver_waves(routed(spark, []), 1, place, send, progress_columns())["records"] == 0
    assert len(got) == 300 and os.listdir(place) == ["1"]


def test_a_large_batch_has_more_fragments_than_writers(spark, tmp_path, monkeypatch):
    """A task's part is bounded by its bytes, whatever the parallelism."""
    monkeypatch.setattr(waves, "FRAGMENT", 400, raising=False)
    got, rows = [], [("t", i % 2, f"value{i:05d}", "bin.1", i, 0, "c") for i in range(400)]
    deliver_waves(routed(spark, rows), 0, str(tmp_path / "waves"), lambda frame: got.append(frame.collect()), progress_columns(), 2)
    assert max(len(wave) for wave in got) < 160 and sum(map(len, got)) == 400
    for part in (0, 1):
        assert [r.pos for wave in got for r in wave if r.partition == part] == list(range(part, 400, 2))


def test_a_snapshot_before_ordered_changes(spark, source, opts, tmp_path):
    out = str(tmp_path / "out")
    plain = table(out)
    target = Target(plain.format, lambda r: plain.record(r if "wave" in r.columns else r.withColumn("wave", F.lit(-1))), plain.options)
    rows = Table(spark.range(10).selectExpr("id", "id * 2.0D AS price"))
    run_job(spark, source, opts, target, {"test.tb_order": rows}, available_now=True).awaitTermination()
    assert spark.read.parquet(out).where("wave = -1").count() == 10


def test_waves_need_an_order():
    with pytest.raises(ValueError, match="in_waves"):
        Options(in_waves=True)
