"""Capture, filters, difference and replay."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rowrelay import Position
from rowrelay.functions.position import is_after
from rowrelay.functions.record import decode, parse
from rowrelay.operators import capture
from rowrelay.operators.filters import include, include_pattern
from rowrelay.operators.replay import apply_changes, last_changes, replay, replay_records
from rowrelay.plans.tablelog import change_log, order_versions
from rowrelay.sources.tables import read_parquet

MARK = Position(1, 3000)


def change(spark, *rows):
    """A change frame from (op, file, pos, row, before id, after id, value)."""
    frame = spark.createDataFrame(
        list(rows), "op string, file string, pos bigint, row int, b bigint, a bigint, v string"
    )
    image = "CASE WHEN {0} IS NOT NULL THEN named_struct('id', {0}, 'v', v) END"
    return frame.selectExpr(
        f"{image.format('b')} AS before",
        f"{image.format('a')} AS after",
        "named_struct('db', 'd', 'table', 't', 'file', file, 'pos', pos, 'row', row, 'ts_ms', pos * 10) AS source",
        "op",
        "pos AS ts_ms",
        "CAST(NULL AS STRING) AS transaction",
    )


def ids(frame):
    return sorted(r.after.id for r in frame.collect())


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_snapshot_keeps_every_row_and_moves_none(spark, small):
    rows = read_parquet(spark, small, "orders")
    records = capture.snapshot(rows, "test", "tb_order", mark=MARK)
    assert records.count() == rows.count()
    assert records.where("before IS NULL AND op = 'r' AND source.snapshot = 'true'").count() == rows.count()
    assert "Exchange" not in records._jdf.queryExecution().executedPlan().toString()
    assert rows_of(records.select("after.*")) == rows_of(rows)


def test_log_files_order_by_number(spark):
    """File 10 comes after file 9 although its name sorts first."""
    log = change(
        spark,
        ("c", "bin.9", 900, 0, None, 1, "x"),
        ("c", "bin.10", 5, 0, None, 2, "x"),
        ("c", "bin.10", 5, 1, None, 3, "x"),
        ("c", "bin.10", 6, 0, None, 4, "x"),
    )
    assert ids(capture.latest(log, Position(9, 900))) == [2, 3, 4]
    assert ids(capture.latest(log, Position(10, 5))) == [3, 4]
    assert ids(capture.latest(log, Position(10, 5, 1))) == [4]
    assert capture.high_water_mark(log) == Position(10, 6, 0)
    assert capture.high_water_mark(log.limit(0)) is None


def test_timestamp_start(spark):
    log = change(spark, *[("c", "bin.1", p, 0, None, p, "x") for p in (1, 2, 3)])
    assert ids(capture.from_timestamp(log, 20)) == [2, 3]
    with pytest.raises(ValueError):
        capture.from_timestamp(log, 0)


def test_start_modes(spark):
    log = change(spark, *[("c", "bin.1", p, 0, None, p, "x") for p in (1, 2, 3)])
    table = spark.createDataFrame([(1, "x"), (2, "x")], "id bigint, v string")
    shot = capture.snapshot(table, "d", "t", mark=Position(1, 2))
    shot = shot.withColumn("source", F.expr("named_struct('db', source.db, 'table', source.table, 'file', source.file, 'pos', source.pos, 'row', source.row, 'ts_ms', source.ts_ms)"))
    mark = Position(1, 2)
    initial = capture.start(0, log, mark=mark, snapshot_changes=shot)
    assert sorted((r.op, r.after.id) for r in initial.collect()) == [("c", 3), ("r", 1), ("r", 2)]
    assert ids(capture.start(2, log, mark=mark)) == [3]
    assert ids(capture.start(9, log, mark=mark)) == [3]
    assert ids(capture.start(4, log, mark=mark, epoch_ms=20)) == [2, 3]
    for mode in (1, 3):
        with pytest.warns(UserWarning, match="treated as latest"):
            assert ids(capture.start(mode, log, mark=mark)) == [3]
    with pytest.raises(ValueError):
        capture.start(0, log, mark=mark)
    with pytest.raises(ValueError):
        capture.start(4, log, mark=mark)


def test_handoff_at_any_mark_gives_the_final_table(spark, small):
    """No gap and no repeat, wherever the snapshot was taken."""
    log = change_log(spark, small)
    final = rows_of(replay(log).select("db", "table", "after.*"))
    for pos in (0, 1, 2999, 3000, 10**9):
        mark = Position(1, pos)
        past = log.where(~is_after(mark) & (F.col("source.db") == "test"))
        shot = capture.snapshot(replay(past).select("after.*"), "test", "tb_order", mark=mark)
        both = capture.handoff(shot, log, mark)
        assert rows_of(replay(both).select("db", "table", "after.*")) == final


def test_include_pattern():
    assert include_pattern("") is None
    assert include_pattern(" , ") is None
    assert include_pattern("a, b") == "(?i)^(?:(?:a)|(?:b))$"
    assert include_pattern(r"a{1\,2},b") == "(?i)^(?:(?:a{1,2})|(?:b))$"


@pytest.mark.parametrize(
    "databases, tables, schema_changes, kept",
    [
        ("", "", True, "abcdefg"),
        ("test", "", True, "abde"),
        ("TEST", "", True, "abde"),
        ("tes", "", True, ""),
        ("test|crm", "", True, "abcde"),
        ("test,crm", "", True, "abcde"),
        ("", "test.t1", True, "adefg"),
        ("", r"test\.t.", True, "abdefg"),
        ("", "t1", True, "defg"),
        ("test", r"crm\..*", True, "de"),
        ("test", "", False, "ab"),
        ("", "", False, "abc"),
    ],
)
def test_include(spark, wire, databases, tables, schema_changes, kept):
    records = {
        "a": ("test", "t1", "c"),
        "b": ("test", "t2", "c"),
        "c": ("crm", "t1", "c"),
        "d": ("test", "", None),
        "e": ("test", None, None),
        "f": (None, None, None),
        "g": ("", "", None),
    }
    texts = [
        json.dumps({"source": {"db": db, "table": table}, "op": op, "mark": mark})
        for mark, (db, table, op) in records.items()
    ]
    found = include(parse(wire(*texts)), databases, tables, schema_changes)
    assert "".join(sorted(json.loads(r.value)["mark"] for r in found.collect())) == kept


def test_diff_of_small_tables(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], "id int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (4, None), (5, "d")], "id int, v string")
    found = capture.diff(old, new, ["id"], "d", "t", mark=Position(1, 1))
    got = {(r.op, r.before and tuple(r.before), r.after and tuple(r.after)) for r in found.collect()}
    assert got == {("d", (1, "a"), None), ("u", (3, None), (3, "c")), ("c", None, (5, "d"))}
    assert capture.diff(old, old, ["id"], "d", "t", mark=Position(1, 1)).count() == 0
    with pytest.raises(ValueError):
        capture.diff(old, new.drop("v"), ["id"], "d", "t", mark=Position(1, 1))


def test_diff_on_several_keys(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "k int, l string, v int")
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 1)], "k int, l string, v int")
    changes = capture.diff(old, new, ["k", "l"], "d", "t", mark=Position(1, 1))
    assert sorted(r.op for r in changes.collect()) == ["c", "u"]
    assert rows_of(apply_changes(old, changes, ["k", "l"], "d", "t")) == rows_of(new)


def test_diff_applied_gives_the_other_version(spark, small):
    old, new = order_versions(spark, small)
    for a, b in ((old, new), (new, old)):
        changes = capture.diff(a, b, ["id"], "test", "tb_order", mark=MARK)
        assert rows_of(apply_changes(a, changes, ["id"], "test", "tb_order")) == rows_of(b)


@pytest.mark.parametrize("seed", range(4))
def test_diff_and_apply_of_random_tables(spark, seed):
    """Nulls, repeated values, added, lost and changed rows in any mix."""
    draw = random.Random(seed)

    def table():
        keys = draw.sample(range(40), draw.randrange(0, 40))
        rows = [(k, draw.choice([None, "", "a", "b"]), draw.choice([None, 0.0, 1.5])) for k in keys]
        return spark.createDataFrame(rows, "id int, v string, x double")

    old, new = table(), table()
    changes = capture.diff(old, new, ["id"], "d", "t", mark=MARK)
    other = capture.diff(new, old, ["id"], "d", "other", mark=MARK)
    both = changes.unionByName(other)
    assert rows_of(apply_changes(old, both, ["id"], "d", "t")) == rows_of(new)
    before, after = ({r[0]: tuple(r) for r in t.collect()} for t in (old, new))
    changed = sum(before.get(k) != after.get(k) for k in before.keys() | after.keys())
    assert changes.count() == changed


def test_replay_ranks_by_position(spark):
    log = change(
        spark,
        ("u", "bin.10", 1, 0, 1, 1, "last"),
        ("u", "bin.9", 9, 0, 1, 1, "older"),
        ("c", "bin.9", 1, 0, None, 1, "first"),
        ("c", "bin.9", 2, 0, None, 2, "x"),
        ("d", "bin.9", 2, 1, 2, None, "x"),
        ("d", "bin.9", 3, 0, 3, None, "x"),
        ("c", "bin.9", 4, 0, None, 3, "again"),
        (None, "bin.9", 5, 0, None, None, None),
    )
    assert sorted(tuple(r.after) for r in replay(log).collect()) == [(1, "last"), (3, "again")]
    twice = log.unionByName(log)
    assert sorted(tuple(r.after) for r in replay(twice).collect()) == [(1, "last"), (3, "again")]


def test_replay_keeps_one_record_per_key_before_the_shuffle(spark):
    """A key with a third of all changes leaves each map task as one record."""
    keys = "CASE WHEN id % 3 = 0 THEN 0 ELSE id END"
    log = spark.range(0, 30000, 1, 8).selectExpr(
        f"named_struct('id', {keys}, 'v', id) AS before",
        f"named_struct('id', {keys}, 'v', id) AS after",
        "named_struct('db', 'd', 'table', 't', 'file', 'bin.1', 'pos', id, 'row', 0) AS source",
        "'u' AS op",
    )
    state = last_changes(log)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert state.count() == 20001
    assert state.where("_key_id = 0").first().after.v == 29997


def test_records_without_a_place_in_the_log(spark):
    """Snapshot records may carry an empty log file: kept by every start, oldest in a replay."""
    log = change(
        spark,
        ("r", "", 0, 0, None, 1, "row"),
        ("r", None, None, None, None, 2, "row"),
        ("u", "bin.1", 5, 0, 1, 1, "new"),
    )
    assert ids(capture.latest(log, Position(1, 5))) == [1, 2]
    assert ids(capture.from_timestamp(log, 50)) == [1, 2]
    assert sorted(tuple(r.after) for r in replay(log).collect()) == [(1, "new"), (2, "row")]
    assert capture.high_water_mark(log) == Position(1, 5, 0)


def test_truncates_are_refused(spark):
    """A truncate has no row image; replaying around it would keep the rows that it ended."""
    changes = capture.diff(*[spark.createDataFrame(r, "id int, v int") for r in ([(1, 1)], [(1, 2)])], ["id"], "d", "t", mark=MARK)
    for frame in (replay(changes.withColumn("op", F.lit("t"))), replay_records(changes.select("op", "source.file", "source.pos", "source.row", "source.db", "source.table", F.lit(1).alias("row_id"), F.lit(1).alias("before_id"), F.lit("t").alias("value")).withColumn("op", F.lit("t")))):
        with pytest.raises(Exception, match="truncate"):
            frame.collect()


def test_truncates_end_earlier_rows(spark):
    """Only those of their table; a row written again after the truncate is there."""
    def event(db, op, pos, key):
        image = f'{{"id":{key}}}' if op == "c" else "null"
        return (f'{{"before":null,"after":{image},"source":{{"db":"{db}","table":"t","file":"b.1","pos":{pos},"row":0}},"op":"{op}"}}',)

    texts = [event("a", "c", 1, 1), event("a", "c", 2, 2), event("a", "t", 3, 0), event("a", "c", 4, 2), event("b", "c", 1, 1), event("a", "c", 3, 9)]
    wire = spark.createDataFrame(texts, "value string")
    state = replay(decode(wire, "id: bigint"), truncates=True)
    assert sorted((r.db, r.after.id) for r in state.collect()) == [("a", 2), ("b", 1)]
    last = replay_records(parse(wire, position=True, before=True), truncates=True)
    assert sorted((r.db, int(r.row_id), r.pos) for r in last.collect()) == [("a", 2, 4), ("b", 1, 1)]


def test_the_change_set_is_computed_once(spark, small):
    from rowrelay.plans.queries import apply_mixed_log, diff_applied

    for query in (diff_applied, apply_mixed_log):
        assert "FullOuter" not in query(spark, small)._jdf.queryExecution().executedPlan().toString()
