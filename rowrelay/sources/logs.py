"""Logs that a job can follow: where one ends now, and its records from such a mark on.

A log object has four methods. ``end`` takes the mark of a first start and ``stored`` and
``store`` keep it next to the job; ``follow`` gives the stream of texts after a mark, and
the options to deliver it with.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.functions.offsets import Offsets, end_of, is_from
from rowrelay.functions.position import BEFORE_ALL, Position
from rowrelay.options import Options
from rowrelay.sources.changelog import kafka_source_options, limit_files, stream_text, with_values
from rowrelay.sources.logindex import LogIndex

#: What a reader of Kafka gives of each message that matters here.
MESSAGE = "topic string, partition int, offset bigint, value binary"


class Log(Protocol):
    def end(self, spark: SparkSession, opts: Options, place: str) -> Position | Offsets: ...

    def store(self, spark: SparkSession, path: str, mark: Position | Offsets) -> None: ...

    def stored(self, spark: SparkSession, path: str) -> Position | Offsets: ...

    def follow(self, spark: SparkSession, opts: Options, mark: Position | Offsets | None) -> tuple[DataFrame, Options]: ...


@dataclass(frozen=True)
class TextLog:
    """A folder of record texts. Its mark is a position of the database's log."""

    path: str

    def end(self, spark: SparkSession, opts: Options, place: str) -> Position:
        """From an index of the files next to the job, which parses each file once."""
        return LogIndex(spark, self.path, f"{place}-index", opts.key_column).end() or BEFORE_ALL

    def store(self, spark: SparkSession, path: str, mark: Position) -> None:
        row = spark.range(1, numPartitions=1).select(*[F.lit(v).alias(n) for n, v in vars(mark).items()])
        row.write.mode("overwrite").json(path)

    def stored(self, spark: SparkSession, path: str) -> Position:
        return Position(*spark.read.schema("sequence long, pos long, row int").json(path).first())

    def follow(self, spark: SparkSession, opts: Options, mark: Position | None) -> tuple[DataFrame, Options]:
        if mark is not None:
            opts = opts.with_(start_after=mark)
        return stream_text(spark, self.path, opts), opts


class _Partitioned:
    """What logs of messages share: their mark is a vector of offsets."""

    def store(self, spark: SparkSession, path: str, mark: Offsets) -> None:
        rows = [(t, p, o) for (t, p), o in sorted(mark.following.items())]
        frame = spark.createDataFrame(rows, "topic string, partition int, following bigint")
        frame.coalesce(1).write.mode("overwrite").json(path)

    def stored(self, spark: SparkSession, path: str) -> Offsets:
        rows = spark.read.schema("topic string, partition int, following bigint").json(path).collect()
        return Offsets({(r.topic, r.partition): r.following for r in rows})


@dataclass(frozen=True)
class KafkaLog(_Partitioned):
    """Topics that carry change records, with their partition counts. Needs Spark's Kafka package.

    The end is read from the messages' offsets when a job starts first, from ``since`` on: a
    vector that an earlier job had reached, without which the topics are read once.
    """

    topics: Mapping[str, int]
    since: Offsets = Offsets()

    def end_options(self, opts: Options) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": opts.brokers,
            "subscribe": ",".join(sorted(self.topics)),
            "startingOffsets": self.since.starting(self.topics),
            "endingOffsets": "latest",
        }

    def end(self, spark: SparkSession, opts: Options, place: str) -> Offsets:
        found = end_of(spark.read.format("kafka").options(**self.end_options(opts)).load())
        return found.joined(self.since)

    def follow_options(self, opts: Options, mark: Offsets | None) -> dict[str, str]:
        options = kafka_source_options(opts, ",".join(sorted(self.topics)))
        return options if mark is None else {**options, "startingOffsets": mark.starting(self.topics)}

    def follow(self, spark: SparkSession, opts: Options, mark: Offsets | None) -> tuple[DataFrame, Options]:
        return with_values(spark.readStream.format("kafka").options(**self.follow_options(opts, mark)).load()), opts


@dataclass(frozen=True)
class MessageFiles(_Partitioned):
    """Parquet files of messages kept with their topic, partition and offset, in a folder that grows.

    Files may overlap: a message before the mark is left out, whatever file it is in. One
    that two later files have is delivered twice.
    """

    path: str

    def end(self, spark: SparkSession, opts: Options, place: str) -> Offsets:
        """Reads the three narrow columns only."""
        return end_of(spark.read.schema(MESSAGE).parquet(self.path))

    def follow(self, spark: SparkSession, opts: Options, mark: Offsets | None) -> tuple[DataFrame, Options]:
        messages = limit_files(spark.readStream.schema(MESSAGE).format("parquet"), opts).load(self.path)
        return with_values(messages if mark is None else messages.where(is_from(mark))), opts
