"""Topic and partition of each record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowrelay import fixed
from rowrelay.functions.values import wrap_to_int
from rowrelay.options import Options, check_partitions

# The map of partition counts is broadcast; one this long takes about 100 MB.
TOPIC_LIMIT = 1_000_000


def topic(db: Column, table: Column) -> Column:
    """``mysqlbinlog_<db>_<table>``; null and empty names go to the fallback topic."""
    named = (F.coalesce(db, F.lit("")) != "") & (F.coalesce(table, F.lit("")) != "")
    name = F.concat(F.lit(fixed.TOPIC_PREFIX), db, F.lit(fixed.TOPIC_SEPARATOR), table)
    return F.when(named, name).otherwise(F.lit(fixed.FALLBACK_TOPIC))


def partition(row_id: Column, count: Column) -> Column:
    """The id's low 32 bits modulo the partition count; no row image means slot 0.

    ``pmod`` keeps negative ids, and ids that wrap to negative, in range.
    """
    wrapped = F.coalesce(wrap_to_int(row_id), F.lit(0))
    return F.pmod(wrapped, count.cast("int")).cast("int")


def with_topic(records: DataFrame, opts: Options = Options()) -> DataFrame:
    router = opts.router or topic
    return records.withColumn("topic", router(F.col("db"), F.col("table")))


def with_partition(records: DataFrame, opts: Options = Options()) -> DataFrame:
    """Add ``partition``, given ``topic`` and ``row_id``.

    A map of counts, an option that the driver holds already, is broadcast at every
    size, so records are never shuffled by topic; a map of over ``TOPIC_LIMIT`` topics
    is refused.
    """
    check_partitions(opts.partitions)
    chooser = opts.partitioner or partition
    row_id = F.col("row_id")
    if opts.delete_partition == "before_id":
        row_id = F.coalesce(row_id, F.col("before_id"))
    counts, default = opts.partitions, F.lit(opts.default_partitions)
    if not isinstance(counts, Mapping):
        return records.withColumn("partition", chooser(row_id, F.lit(counts)))
    if not counts:
        return records.withColumn("partition", chooser(row_id, default))
    if len(counts) > TOPIC_LIMIT:
        raise ValueError(f"partition counts of {len(counts)} topics; at most {TOPIC_LIMIT} are broadcast")
    table = F.broadcast(records.sparkSession.createDataFrame(list(counts.items()), "topic string, _count int"))
    columns = [*records.columns, "partition"]
    count = F.coalesce(F.col("_count"), default)
    joined = records.join(table, "topic", "left")
    return joined.withColumn("partition", chooser(row_id, count)).select(*columns)


def route(records: DataFrame, opts: Options = Options()) -> DataFrame:
    """Add ``topic`` and ``partition`` to parsed records."""
    return with_partition(with_topic(records, opts), opts)


def fanout_counts(routed: DataFrame) -> DataFrame:
    """Records per topic, partition and operation; partial counts are shuffled, not records."""
    return routed.groupBy("topic", "partition", "op").agg(F.count(F.lit(1)).alias("records"))
