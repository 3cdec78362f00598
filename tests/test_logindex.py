"""Starts by the log's index: which files are read, and that no record is lost."""

import pytest

from rowrelay import Options, Position
from rowrelay.functions.position import is_after
from rowrelay.functions.record import parse
from rowrelay.plans.tablelog import EPOCH_MS, wire_log
from rowrelay.sources import logindex
from rowrelay.sources.logindex import LogIndex

MARK = Position(1, 3000)


@pytest.fixture
def log(spark, small, tmp_path):
    """The log in files of 500 positions each, and an index of it."""
    path = str(tmp_path / "log")
    wire = parse(wire_log(spark, small), position=True)
    for low in range(0, 6500, 500):
        wire.where(f"file = 'binlog.000001' AND pos >= {low} AND pos < {low + 500}").select("value").coalesce(1).write.mode("append").text(path)
    wire.where("file <> 'binlog.000001' OR pos >= 6500").select("value").coalesce(1).write.mode("append").text(path)
    return path, LogIndex(spark, path, str(tmp_path / "index"))


def texts(frame):
    return sorted(r.value for r in frame.collect())


def test_end_and_starts(spark, small, log):
    path, index = log
    wire = parse(wire_log(spark, small), position=True)
    last = wire.where("file = 'binlog.000003'").agg({"pos": "max"}).first()[0]
    assert index.end() == Position(3, last, 0)
    after = index.read_after(MARK)
    assert len(after.inputFiles()) < len(spark.read.text(path).inputFiles()) - 5
    later = is_after(MARK, "")
    assert texts(parse(after, position=True).where(later)) == texts(wire.where(later))
    assert len(index.read_after(MARK, Position(1, 3600)).inputFiles()) == 2
    start = EPOCH_MS + 4_000_000
    since = index.read_since(start)
    assert len(since.inputFiles()) < len(spark.read.text(path).inputFiles()) - 5
    assert texts(parse(since, position=True).where(f"source_ts_ms >= {start}")) == texts(wire.where(f"source_ts_ms >= {start}"))
    assert texts(index.read_after(Position(9, 0))) == []


def test_files_are_parsed_once(spark, log, monkeypatch):
    path, index = log
    parsed, entries = [], logindex._entries
    monkeypatch.setattr(logindex, "_entries", lambda spark, files, key: (parsed.append(len(files)), entries(spark, files, key))[1])
    before = index.refresh().count()
    index.end()
    text = '{"source":{"db":"a","table":"b","file":null,"pos":null},"op":"c","after":{"id":1}}'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)
    assert index.refresh().count() == before + 1
    assert parsed == [before, 1]
    assert text in texts(index.read_after(Position(9, 0))) and text in texts(index.read_since(10**15))


def test_no_log_yet(spark, tmp_path):
    spark.createDataFrame([], "value string").write.text(str(tmp_path / "log"))
    index = LogIndex(spark, str(tmp_path / "log"), str(tmp_path / "index"), Options().key_column)
    assert index.end() is None and texts(index.read_after(MARK)) == []
