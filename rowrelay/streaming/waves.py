"""Ordered delivery to a live target by more than one task for a topic partition.

A micro-batch is cut into fragments, consecutive ranges of a topic partition's log order,
which are written to a shared folder first. Then they are sent in waves: a wave holds one
fragment of each topic partition, and begins when the wave before it has been sent. So
two tasks never write to a topic partition at the same time, and none has to hold one whole.

The folder tells what was done: which waves were sent, and at the end the batch's
counters. A batch that broke off goes on with the wave it was in, from the fragments
already written, and a batch that was sent whole is not sent again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from rowrelay.operators.ordering import GROUP, exclusive_order, fragments
from rowrelay.streaming.folders import file_system, names_in, put_text


#: Bytes of text in a fragment; a larger batch is cut into more fragments than ``parallelism``.
FRAGMENT = 128 << 20


def _written(spark: SparkSession, path: str) -> bool:
    system, success = file_system(spark, f"{path}/_SUCCESS")
    return system.exists(success)


def _kept(frame: DataFrame, path: str, schema: StructType) -> DataFrame:
    """The frame as written to the path, now or by an earlier start that finished it."""
    spark = frame.sparkSession
    if not _written(spark, path):
        folders = [c for c in ("fragment",) if c in frame.columns]
        frame.write.mode("overwrite").partitionBy(*folders).parquet(path)
    return spark.read.schema(schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    system, there = file_system(spark, path)
    system.delete(there, True)


def _cut(batch: DataFrame, here: str, parallelism: int | None) -> DataFrame:
    """The batch's records with their fragments, ``parallelism`` or as many as keep each near ``FRAGMENT``.

    The batch is written as it comes first, so that it is parsed once, although it is measured and
    a range exchange reads its input twice.
    """
    spark, path = batch.sparkSession, f"{here}/rows"
    schema = StructType([*batch.schema.fields]).add("fragment", IntegerType())
    if not _written(spark, path):
        whole = _kept(batch, f"{here}/batch", batch.schema)
        size = whole.agg(F.sum(F.octet_length("value"))).first()[0] or 0
        pieces = max(parallelism or 1, -(-size // FRAGMENT))
        _kept(fragments(whole, pieces), path, schema)
    _forget(spark, f"{here}/batch")
    return spark.read.schema(schema).parquet(path)


def spans(rows: DataFrame) -> DataFrame:
    """(topic, partition, first, last): the fragments of each topic partition, which are consecutive."""
    return rows.groupBy(*GROUP).agg(F.min("fragment").alias("first"), F.max("fragment").alias("last"))


def wave(rows: DataFrame, ranges: DataFrame, number: int, parallelism: int | None = None) -> DataFrame:
    """The fragment of that number of each topic partition that has so many, with column ``wave``.

    Fragments are folders, so later waves, with few topic partitions, read few of them.
    """
    due = ranges.where(F.col("last") - F.col("first") >= number).select(
        F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), (F.col("first") + number).alias("_fragment")
    )
    same = (F.col("fragment") == F.col("_fragment")) & F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    own = rows.join(due, same, "left_semi").withColumn("wave", F.lit(number))
    return exclusive_order(own, parallelism)


def deliver_waves(
    batch: DataFrame,
    batch_id: int,
    place: str,
    write: Callable[[DataFrame], None],
    counters: list,
    parallelism: int | None = None,
) -> dict[str, int]:
    """Send a batch of routed records in order by ``write``; returns its counters.

    ``place`` belongs to one checkpoint and must go with it, as batch ids begin anew with a
    new one. A batch that is run again is sent as it was cut and routed at first. An
    empty batch has no waves. Topics and partitions may be null. Records of one position
    have no order among themselves. At least once: a wave that breaks off is sent again whole.
    """
    spark, here = batch.sparkSession, f"{place}/{batch_id}"
    for name in names_in(spark, place):
        if name.isdigit() and int(name) < batch_id:
            _forget(spark, f"{place}/{name}")
    if "done" in names_in(spark, here):
        return json.loads(spark.read.text(f"{here}/done", wholetext=True).first().value)
    rows = _cut(batch, here, parallelism)
    found = spans(rows)
    ranges = _kept(found, f"{here}/spans", found.schema)
    longest = ranges.agg(F.max(F.col("last") - F.col("first"))).first()[0]
    sent = {int(n) for n in names_in(spark, f"{here}/sent")}
    for number in range(0 if longest is None else longest + 1):
        if number not in sent:
            write(wave(rows, ranges, number, parallelism))
            put_text(spark, f"{here}/sent", str(number), "")
    counts = rows.agg(*counters).first().asDict()
    put_text(spark, here, "done", json.dumps(counts))
    for part in ("rows", "spans", "sent"):
        _forget(spark, f"{here}/{part}")
    return counts
