"""Images read by the columns of their time."""

import json

import pytest

from rowrelay.operators.timeline import column_lists, decode_by_timeline


def change(pos, columns, table="t", kind="ALTER", wrap=False, file="binlog.000001"):
    listed = [{"name": n, "position": i + 1, "typeName": "INT", "nativeType": 4} for i, n in enumerate(columns)]
    found = [{"type": kind, "id": f'"app"."{table}"', "table": {"columns": listed[::-1]} if kind != "DROP" else None}]
    where = {"db": "app", "table": table, "file": file, "pos": pos, "row": 0, "ts_ms": 1}
    body = {"historyRecord": json.dumps({"ddl": "ALTER ...", "tableChanges": found})} if wrap else {"tableChanges": found}
    return json.dumps({"source": where, **body})


def record(pos, after, before=None, table="t", op="u", file="binlog.000001"):
    where = {"db": "app", "table": table, "file": file, "pos": pos, "row": 0, "ts_ms": 1}
    return json.dumps({"before": before, "after": after, "source": where, "op": op})


def decoded(wire, *texts, salts=3):
    frame = wire(*texts)
    rows = decode_by_timeline(frame, column_lists(frame), salts).where("op IS NOT NULL").collect()
    flat = lambda image: None if image is None else {c.name: c.value for c in image}
    return {(r.table, r.file[-1] if r.file else None, r.pos): (flat(r.before), flat(r.after), r.extra) for r in rows}


def test_lists_by_place(wire):
    """Before the first list, at a change, after it, after a drop, and in a later log file."""
    texts = [
        change(10, ["id", "a"]), change(20, ["id", "a", "b"], wrap=True), change(20, ["id", "a", "b"], wrap=True),
        change(30, [], kind="DROP"), change(5, ["id"], file="binlog.000002"), change(1, ["x"], table="other"),
        *[record(p, {"id": 1, "a": 2}) for p in (9, 10, 19)], record(20, {"id": 1, "a": None, "b": [1]}, {"id": 1, "a": 5}),
        record(31, {"id": 1}), record(4, {"id": 1}, file="binlog.000002"), record(6, {"id": 7, "new": 1}, file="binlog.000002"),
        record(40, {"x": "é"}, table="other"), record(40, {"x": 1}, table="unlisted"), record(40, None, {"x": 1}, table="other", op="d").replace("40", "41"),
    ]
    assert decoded(wire, *texts) == {
        ("t", "1", 9): (None, None, ["a", "id"]),
        ("t", "1", 10): (None, {"id": "1", "a": "2"}, []),
        ("t", "1", 19): (None, {"id": "1", "a": "2"}, []),
        ("t", "1", 20): ({"id": "1", "a": "5", "b": None}, {"id": "1", "a": None, "b": "[1]"}, []),
        ("t", "1", 31): (None, None, ["id"]),
        ("t", "2", 4): (None, None, ["id"]),
        ("t", "2", 6): (None, {"id": "7"}, ["new"]),
        ("other", "1", 40): (None, {"x": "é"}, []),
        ("unlisted", "1", 40): (None, None, ["x"]),
        ("other", "1", 41): ({"x": "1"}, None, []),
    }


def test_columns_keep_their_order(spark, wire):
    row = column_lists(wire(change(1, ["z", "a", "m"]))).first()
    assert ([c.name for c in row.columns], row.until) == (["z", "a", "m"], None)


def test_each_record_once(spark, wire):
    """However many lists and salts there are; records without a place have no list."""
    texts = [change(10 * i, ["id", *[f"c{j}" for j in range(i)]]) for i in range(50)]
    texts += [record(10 * i + 5, {"id": i, **{f"c{j}": j for j in range(i)}}) for i in range(50)] * 2
    texts.append(record(None, {"id": 1}, file=None))
    frame = wire(*texts)
    rows = decode_by_timeline(frame, column_lists(frame)).where("op IS NOT NULL").collect()
    assert len(rows) == 101
    assert sorted(len(r.after) for r in rows if r.after) == sorted([*range(1, 51)] * 2)
    assert [r.extra for r in rows if r.extra] == [["id"]]


def test_logs_without_records_or_lists(wire):
    assert decoded(wire) == {}
    assert decoded(wire, record(1, {"id": 1})) == {("t", "1", 1): (None, None, ["id"])}


def test_a_bad_record_fails(wire):
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        decoded(wire, change(1, ["id"]), "not json")
