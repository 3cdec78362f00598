"""A log kept parsed gives what its texts give."""

import json

import pytest

from rowrelay import Options, Position, deliveries
from rowrelay.functions.record import decode, parse
from rowrelay.operators.replay import last_changes
from rowrelay.plans.delivery import routed_records
from rowrelay.plans.tablelog import IMAGE, event_log, wire_log
from rowrelay.sources.parsedlog import ParsedLog, parsed

SOURCE = {"db": "app", "table": "t", "file": "binlog.000001", "pos": 4, "row": 1, "ts_ms": 9}


def text(after=None, before=None, source=SOURCE, op="c"):
    return json.dumps({"before": before, "after": after, "source": source, "op": op, "other": [1, {"x": None}]})


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_fields_as_parsed_from_the_text(wire):
    texts = [text({"id": i}) for i in (0, -7, 2**63, 12345678901234567890123, 1.9, -1.9, "42", "007")]
    texts += ['{"after":{"id":1e3},"source":{"db":"a"},"op":"c"}', '{"source":{"db":null,"table":""}}', text(None, {"id": 5}, op="d"), text({"id": 1, "é": "x" * 100_000})]
    texts += ['{"after":null,"before":null,"source":{"db":"a","pos":null},"op":null}', texts[0]]
    frame = wire(*texts)
    columns = ["value", "db", "table", "op", "row_id", "before_id", "file", "pos", "row", "source_ts_ms"]
    assert rows(parsed(frame).select(columns)) == rows(parse(frame, position=True, before=True).select(columns))


@pytest.mark.parametrize("bad", ["not json", "", '{"op":"c"}', '{"source":null}', text({"name": 1}), text({"id": None}), text({"id": "x"}), text({"id": 10**40}), None])
def test_bad_records_fail(spark, bad):
    frame = spark.createDataFrame([(text({"id": 1}),), (bad,)], "value string")
    with pytest.raises(Exception):
        parsed(frame).collect()


def test_other_key_columns(wire):
    frame = wire(text({"a.b c": 5, "id": 1}))
    assert [int(r.row_id) for r in parsed(frame, "a.b c").collect()] == [5]
    with pytest.raises(ValueError):
        parsed(frame, "it's")


def test_one_parse_for_several_jobs(spark, small, tmp_path):
    """Routes by any options, and images, as from the texts; no job parses JSON."""
    log, both = ParsedLog(spark, str(tmp_path / "log")), wire_log(spark, small).unionByName(event_log(spark, small))
    log.add(wire_log(spark, small), 0)
    log.add(event_log(spark, small), 1)
    log.add(event_log(spark, small), 1)
    columns = ["value", "db", "table", "op", "row_id", "topic", "partition"]
    for opts in (Options(partitions=4), Options(databases="app", delete_partition="before_id"), Options(start_mode=4, start_timestamp=1704067300000), Options(start_after=Position(1, 3000))):
        found = routed_records(log.records(), opts)
        assert rows(found.select(columns)) == rows(deliveries(both, opts).select(columns))
        assert "from_json" not in found._jdf.queryExecution().executedPlan().toString()
    own = wire_log(spark, small)
    found = last_changes(log.changes(IMAGE).where("source.db <> 'app'")).drop("_log")
    assert rows(found) == rows(last_changes(decode(own, IMAGE)))


def test_columns_that_a_job_does_not_need_are_not_read(spark, small, tmp_path):
    log = ParsedLog(spark, str(tmp_path / "log"))
    log.add(wire_log(spark, small), 0)
    plan = log.changes(IMAGE).select("op", "after.id")._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :]
    assert "value" not in schema and "before" not in schema and "after" in schema


def test_an_empty_log(spark, small, tmp_path):
    log = ParsedLog(spark, str(tmp_path / "log"))
    log.add(wire_log(spark, small).where("false"), 0)
    assert log.records().count() == 0 and log.changes(IMAGE).count() == 0
