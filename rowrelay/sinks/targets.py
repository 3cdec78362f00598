"""Targets: a writer format, its options and the record it takes.

The Kafka and Pulsar targets name Spark connector packages that are given to the
session when the job is submitted; files need nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rowrelay import fixed
from rowrelay.options import Options
from rowrelay.sinks.records import kafka_record, message_record, pulsar_record


#: Records of a compressed file. It can't be cut, and a task gets files by their compressed size: with
#: Spark's defaults some 28 of so few records, which are as large as the parts of an uncompressed file.
RECORDS_PER_FILE = 20_000


@dataclass(frozen=True)
class Target:
    """``single_writer`` marks a live target, where two tasks writing to the same
    topic partition would mix their records."""

    format: str
    record: Callable[[DataFrame], DataFrame]
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    single_writer: bool = True

    def write(self, routed: DataFrame) -> None:
        writer = self.record(routed).write.format(self.format).options(**self.options)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.mode("append").save()


def kafka(opts: Options) -> Target:
    return Target(
        "kafka",
        kafka_record,
        {
            "kafka.bootstrap.servers": opts.brokers,
            "kafka.acks": "all",
            "kafka.transaction.timeout.ms": str(fixed.KAFKA_TRANSACTION_TIMEOUT_MS),
        },
    )


def pulsar(opts: Options) -> Target:
    """The connector takes the topic of each message from the ``__topic`` column."""
    return Target(
        "pulsar",
        lambda routed: pulsar_record(routed).withColumnRenamed("topic", "__topic"),
        {"service.url": opts.service_url, "admin.url": opts.admin_url},
    )


def compressed(codec: str) -> dict[str, str]:
    """Writer options of compressed files, each small enough for the task that reads it."""
    return {"compression": codec, "maxRecordsPerFile": str(RECORDS_PER_FILE)}


def files(path: str, format: str = "text", by_partition: bool = False, compression: str | None = None) -> Target:
    """One folder per topic, and per partition inside it if asked for.

    ``compression`` is a codec of the format, such as ``lz4`` or ``gzip``: change records repeat
    their field names, so their texts shrink to a tenth or less. Spark tells it by the file's name.
    """
    folders = ("topic", "partition") if by_partition else ("topic",)
    return Target(
        format,
        lambda routed: routed.select("value", *folders),
        {"path": path, **(compressed(compression) if compression else {})},
        partition_by=folders,
        single_writer=False,
    )


def messages(client: str, options: Mapping[str, str] | None = None) -> Target:
    """Any message system, through a client named ``module:function``.

    See :mod:`rowrelay.sinks.messages`; the source must be registered with
    ``spark.dataSource.register(MessageSource)``.
    """
    return Target("rowrelay_messages", message_record, {"client": client, **(options or {})})
