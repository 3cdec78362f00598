"""Log order inside each topic partition, and records gathered by topic partition.

``exclusive_order`` gives each topic partition to one task. A live target needs
that, because two writers to the same partition would interleave; it is meant for
micro-batches, whose size is bounded by the source's rate limit.

``fragments`` cuts topic partitions into such pieces first, for a target that takes
them one after another (:mod:`rowrelay.streaming.waves`).

``range_order`` is for input of any size: a topic partition of any weight is cut
into consecutive position ranges handled by different tasks, and output files
follow the order of the tasks. ``write_ranges`` cuts so many that none holds much.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.functions.position import position_order
from rowrelay.streaming.folders import file_system, new_folder

GROUP = ("topic", "partition")
#: Bytes of text in a range at most or nearly, and those for which another core is used.
RANGE, SHARE = 64 << 20, 4 << 20


def exclusive_order(routed: DataFrame, parallelism: int | None = None) -> DataFrame:
    """One task per topic partition, sorted by position. Bounded micro-batches only."""
    size = [parallelism] if parallelism else []
    return routed.repartition(*size, *GROUP).sortWithinPartitions(*GROUP, *position_order(""))


def range_order(routed: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Consecutive ranges of (topic, partition, position) per task, sorted.

    Records that share a position, such as the rows of a snapshot, are told apart by
    their text, so a rerun task sends each to the same range again; the arrival
    number only lets exact copies be split over tasks as well.

    Topic and partition come out of a generator. Catalyst drops a constant one from the
    sort order; the file writer would then miss it there and sort by topic and
    partition once more, which loses the log order.
    """
    size = [parallelism] if parallelism else []
    numbered = routed.select(
        *[F.col(f"`{c}`") for c in routed.columns if c not in GROUP],
        F.xxhash64("value").alias("_text"),
        F.monotonically_increasing_id().alias("_arrival"),
        F.inline(F.array(F.struct(*GROUP))),
    )
    order = [*GROUP, *position_order(""), "_text", "_arrival"]
    arranged = numbered.repartitionByRange(*size, *order).sortWithinPartitions(*order)
    return arranged.select(*routed.columns)


def ranges_of(size: int, cores: int) -> int:
    """How many ranges texts of that many bytes are cut into."""
    return max(1, -(-size // RANGE), min(cores, -(-size // SHARE)))


def write_ranges(routed: DataFrame, write: Callable[[DataFrame], None], parallelism: int | None = None) -> None:
    """Write the records in range order, in ``parallelism`` ranges or as many as keep each near ``RANGE``.

    Spark merges ranges by their compressed size, and change records shrink to a tenth or less, so
    a task would sort some hundred MB of texts, more as the input grows. The records are written to
    the session's folder first: they are parsed once, although they are measured and the
    range exchange reads its input twice.
    """
    if parallelism:
        write(range_order(routed, parallelism))
        return
    spark = routed.sparkSession
    path = new_folder(spark, "arrived")
    system, there = file_system(spark, path)
    try:
        routed.write.parquet(path)
        whole = spark.read.schema(routed.schema).parquet(path)
        size = whole.agg(F.sum(F.octet_length("value"))).first()[0] or 0
        write(range_order(whole, ranges_of(size, spark.sparkContext.defaultParallelism)))
    finally:
        system.delete(there, True)


def fragments(routed: DataFrame, parallelism: int | None = None) -> DataFrame:
    """The records with the number of their range of (topic, partition, position), in ``fragment``.

    A topic partition's fragments have consecutive numbers, each at most one range. Records
    that share a position may be in several.
    """
    size = [parallelism] if parallelism else []
    ordered = routed.repartitionByRange(*size, *GROUP, *position_order(""), F.xxhash64("value"))
    return ordered.withColumn("fragment", F.spark_partition_id())


def spread(routed: DataFrame, parallelism: int | None = None) -> DataFrame:
    """The input's own partitioning, or ``parallelism`` writers, more or fewer than it has.

    Writers get records by a hash of topic, partition and, as the salt, the text's own
    hash: a topic partition with most of the records goes to all of them evenly, and a
    task that is run again sends each record to the same writer.
    """
    if not parallelism:
        return routed
    return routed.repartition(parallelism, *GROUP, F.xxhash64("value"))


def narrow(routed: DataFrame, parallelism: int | None = None) -> DataFrame:
    """At most ``parallelism`` writers: tasks are put together and no record is shuffled."""
    return routed.coalesce(parallelism) if parallelism else routed


def gather(routed: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Bring the records of a topic partition together, in no order.

    Without it every task writes a small file for each topic it meets. A rebalance
    lets Spark cut heavy topic partitions and merge light ones by measured size.
    """
    return routed.hint("rebalance", *([parallelism] if parallelism else []), *GROUP)
