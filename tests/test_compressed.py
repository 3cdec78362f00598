"""Compressed logs and deliveries: the same records in a fraction of the bytes."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from rowrelay import Options
from rowrelay.plans import queries
from rowrelay.plans.delivery import run_batch
from rowrelay.plans.tablelog import event_log, wire_log
from rowrelay.sinks import targets
from rowrelay.sources.changelog import read_files


def written(folder):
    return [os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.startswith("part-")]


def test_compressed_files_hold_the_same_records(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(targets, "RECORDS_PER_FILE", 100)
    plain, packed, wire = str(tmp_path / "plain"), str(tmp_path / "packed"), wire_log(spark, small)
    run_batch(wire, Options(partitions=4), targets.files(plain, by_partition=True))
    for codec in ("lz4", "gzip"):
        out = packed + codec
        run_batch(wire, Options(partitions=4), targets.files(out, by_partition=True, compression=codec))
        rows = lambda folder: sorted(map(tuple, read_files(spark, folder).collect()))
        assert rows(out) == rows(plain) and len(rows(out)) == 2475
        counts = spark.read.text(out).groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
        assert counts == 100 and not any(n.endswith(".txt") for n in written(out))


@pytest.mark.parametrize("name, texts", [("stream_resume", 2), ("job_counters", 2), ("job_initial", 1), ("job_latest", 1), ("job_timestamp", 1), ("job_latest_indexed", 1)])
def test_queries_write_a_fraction_of_their_texts(spark, small, tmp_path, monkeypatch, name, texts):
    """The log and what is delivered of it, counted in bytes of text files."""
    monkeypatch.setattr(queries, "new_folder", lambda spark, kind: str(tmp_path / f"{kind}-{uuid.uuid4().hex}"))
    queries.all_queries()[name](spark, small).collect()
    raw = wire_log(spark, small) if texts == 1 else wire_log(spark, small).unionByName(event_log(spark, small))
    size = raw.agg(F.sum(F.octet_length("value"))).first()[0]
    files = [n for n in written(tmp_path) if ".txt" in n]
    assert files and sum(map(os.path.getsize, files)) < size / 2
