"""The bucketed state: batches in any order, untouched files, repeated batches."""

import pytest
from pyspark.sql import functions as F

from rowrelay.operators.replay import replay
from rowrelay.plans.tablelog import IMAGE, change_log
from rowrelay.sinks.buckets import BucketedState


def rows(frame):
    return sorted(map(str, frame.select("db", "table", "after").collect()))


def test_batches(spark, small, tmp_path):
    log = change_log(spark, small).cache()
    place = str(tmp_path / "state")
    state = BucketedState(spark, place, IMAGE, buckets=8)
    assert rows(state.read()) == [] and state.files() == {}
    late = F.col("source.pos") % 4 == 2  # the deletes come first, then older records
    assert state.merge(log.where(late), 0) == 8
    assert rows(state.read()) == rows(replay(log.where(late)))
    assert state.merge(log.where(~late), 1) == 8
    assert rows(state.read()) == rows(replay(log))
    # A few changes rewrite their buckets only; the others keep their files.
    before = state.files()
    some = log.where("op = 'c' AND after.id = 7 AND source.db = 'test'").withColumn("source", F.col("source").withField("pos", F.lit(10**9).cast("bigint")))
    some = some.withColumn("after", F.col("after").withField("status", F.lit("new")))
    assert BucketedState(spark, place, IMAGE, buckets=99).merge(some, 2) == 1  # the first merge fixed the number
    after = state.files()
    assert sum(after[b] != before[b] for b in before) == 1
    assert state.read().where("after.id = 7 AND after.status = 'new'").count() == 1
    # A batch that is delivered again changes nothing, nor do its records in a later one.
    assert state.merge(some, 2) == 0 and state.files() == after
    state.merge(some.unionByName(log.where(late)), 3)
    assert rows(state.read()) == rows(replay(log.unionByName(some)))


def test_versions(spark, small, tmp_path):
    """A merge that ends before its rename leaves the last version; a lost race is an error."""
    log = change_log(spark, small).where("source.pos < 400").cache()
    state = BucketedState(spark, str(tmp_path / "state"), IMAGE, buckets=4)
    state.merge(log.where("op = 'c'"), 0)
    before = rows(state.read())
    commit, state._commit = state._commit, lambda manifest: (_ for _ in ()).throw(KeyboardInterrupt)
    with pytest.raises(KeyboardInterrupt):
        state.merge(log.where("op <> 'c'"), 1)
    assert rows(state.read()) == before
    state._commit = commit
    state.merge(log.where("op <> 'c'"), 1)
    assert rows(state.read()) == rows(replay(log))
    with pytest.raises(RuntimeError, match="another job"):
        state._commit({"version": 0})
    with pytest.raises(Exception, match="truncate"):
        state.merge(log.limit(1).withColumn("op", F.lit("t")), 2)
    assert state.merge(log.limit(0), 3) == 0 and rows(state.read()) == rows(replay(log))
