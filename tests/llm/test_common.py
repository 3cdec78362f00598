"""The folder that intermediate tables go to."""

from types import SimpleNamespace

import pytest

from rowrelay.llm import common, cotraining, decontaminate, secrets, simhash


def stand_in(master, given=None, setting=None):
    """A session; a running one doesn't let go of its settings."""
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: given, setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: setting), sparkContext=context), made


def test_folder():
    assert common.shared_folder(stand_in("spark://h:1", setting="hdfs:///shared/")[0]) == "hdfs:///shared"
    assert common.shared_folder(stand_in("local[2]", given="file:/set")[0]) == "file:/set"
    session, made = stand_in("local[2]")
    assert [common.shared_folder(session)] == made
    for master in ("spark://h:1", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_folder(stand_in(master)[0])


def test_saved(spark):
    frame = spark.createDataFrame([(1, None), (2, "a")], "a long, b string")
    kept = common.saved(frame, "t")
    assert kept.schema == frame.schema
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, None), (2, "a")]
    assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()


def test_columns_of_any_name_stay(spark):
    """Stages join their decisions by names that the documents don't have."""
    assert common.unused(spark.range(1).selectExpr("1 AS __ID", "2 AS __id_"), "__id", "__of") == ["__id__", "__of"]
    rows = [(i, f"plain words number {i} and more of them {i * 7919}", "en", "a", 40, -i, "x", "y", "z") for i in range(6)]
    rows.append((9, "token: abcdefgh12345678", "en", None, 23, 0, None, None, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __id long, __of string, __spans string, digest string")
    items = spark.createDataFrame([("i", rows[0][1])], "item_id string, text string")
    labels = spark.createDataFrame([], "doc_id long, label int")
    assert sorted(map(tuple, simhash.deduplicated(docs).collect()), key=str) == sorted(rows, key=str)
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [1, 2, 3, 4, 5, 9]
    assert sorted(map(tuple, cotraining.good(docs, labels).collect()), key=str) == sorted(rows, key=str)
    masked = {r.doc_id: r for r in secrets.redacted(docs).collect()}
    assert (masked[9].text, masked[9]["__id"], masked[3]["__id"], masked[9].n_chars) == ("<secret>", 0, -3, 8)
    assert secrets.redacted(docs).columns == docs.columns
