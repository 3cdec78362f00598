"""Change records as text: one JSON record per row, in a ``value`` column."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from rowrelay import fixed
from rowrelay.options import Options


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``topic`` and ``partition`` of files delivered by partition.

    A folder that nothing was delivered to has no topic folders, and gives no rows.
    """
    found = spark.read.text(path)
    if "topic" in found.columns:
        return spark.read.schema("value string, topic string, partition int").text(path)
    none = F.lit(None)
    return found.select("value", none.cast("string").alias("topic"), none.cast("int").alias("partition"))


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``topic``, ``partition`` and ``sequence`` of files delivered by partition.

    ``sequence`` counts the records of a topic partition from 0 in the order of its
    files: by the number of the task that wrote a file, which is in the file's name.
    The lines of a part of a file, which one task reads, have consecutive numbers. A table
    with a row a part, which is broadcast, tells the first of them and the records of
    the parts before, so texts are neither shuffled nor sorted and no task needs a whole
    topic partition. One batch delivery per folder: files of two have no common order.
    """
    files = read_files(spark, path)
    part = ["_file", "_start"]
    lines = files.select(
        "value",
        "topic",
        "partition",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
    )
    group = [F.coalesce("topic", F.lit("")), F.coalesce("partition", F.lit(-1))]
    task = F.regexp_extract("_file", r"part-(\d+)[^/]*$", 1).cast("bigint")
    earlier = Window.partitionBy(*group).orderBy(task, *part).rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("topic", "partition", *part).agg(F.count(F.lit(1)).alias("_n"), F.min("_line").alias("_first"))
    offsets = counts.select(*part, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = lines.join(F.broadcast(offsets), part)
    return numbered.select("value", "topic", "partition", (F.col("_before") + F.col("_line") - F.col("_first")).alias("sequence"))


def limit_files(reader: DataStreamReader, opts: Options) -> DataStreamReader:
    """A stream of files with the limits of one micro-batch. Files can't be limited by records."""
    if opts.max_batch_records:
        raise ValueError("a file stream can't apply max_batch_records; use max_batch_files or max_batch_bytes")
    if opts.max_batch_files:
        reader = reader.option("maxFilesPerTrigger", opts.max_batch_files)
    if opts.max_batch_bytes:
        reader = reader.option("maxBytesPerTrigger", opts.max_batch_bytes)
    return reader


def check_start(opts: Options) -> None:
    """Record texts have no end of their own to start at: a latest start needs its mark."""
    if opts.start_mode not in (fixed.START_INITIAL, fixed.START_TIMESTAMP) and opts.start_after is None:
        raise ValueError(f"start mode {opts.start_mode} needs start_after, the end of the log; run_job takes it")


def stream_text(spark: SparkSession, path: str, opts: Options = Options()) -> DataFrame:
    """A folder of text files as a stream. A latest start is refused without its mark."""
    check_start(opts)
    return limit_files(spark.readStream.format("text"), opts).load(path)


def kafka_start_options(opts: Options) -> dict[str, str]:
    """The start point of a new query; a restarted one continues from its checkpoint."""
    if opts.start_mode == fixed.START_INITIAL:
        return {"startingOffsets": "earliest"}
    if opts.start_mode == fixed.START_TIMESTAMP:
        # A partition without a record that late starts at its end instead of failing.
        return {
            "startingTimestamp": str(opts.start_timestamp),
            "startingOffsetsByTimestampStrategy": "latest",
        }
    if opts.start_mode in (fixed.START_EARLIEST, fixed.START_SPECIFIC):
        warnings.warn(f"start mode {opts.start_mode} is treated as latest", stacklevel=2)
    return {"startingOffsets": "latest"}


def kafka_source_options(opts: Options, topics: str) -> dict[str, str]:
    if opts.max_batch_files or opts.max_batch_bytes:
        raise ValueError("a Kafka stream can only apply max_batch_records")
    options = {
        "kafka.bootstrap.servers": opts.brokers,
        "subscribe": topics,
        "failOnDataLoss": "true",
        **kafka_start_options(opts),
    }
    if opts.max_batch_records:
        options["maxOffsetsPerTrigger"] = str(opts.max_batch_records)
    return options


def stream_kafka(spark: SparkSession, opts: Options, topics: str) -> DataFrame:
    """Topics that carry change records. Needs Spark's Kafka package.

    The records without a value that follow deletes in compacted topics are left out.
    """
    stream = spark.readStream.format("kafka").options(**kafka_source_options(opts, topics)).load()
    return with_values(stream)


def with_values(stream: DataFrame) -> DataFrame:
    """The text of each message that has a value."""
    return stream.where(F.col("value").isNotNull()).select(F.col("value").cast("string").alias("value"))
