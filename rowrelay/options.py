"""Job options: one immutable value handed to the batch and streaming entry points."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column

from rowrelay import fixed
from rowrelay.functions.position import Position

# none: as the input comes; gathered: few files per topic; partition: in log order
ORDERS = ("none", "gathered", "partition")
DELETE_PARTITIONS = ("slot0", "before_id")


def check_partitions(partitions: int | Mapping[str, int]) -> None:
    """A target topic needs at least one partition."""
    counts = partitions.values() if isinstance(partitions, Mapping) else [partitions]
    for count in counts:
        if isinstance(count, bool) or not isinstance(count, int) or count < 1:
            raise ValueError(f"a topic needs at least one partition, got {count!r}")


@dataclass(frozen=True)
class Options:
    """Everything a capture job can be told.

    ``partitions`` is the partition count of the target topics: one number, or a
    map from topic to number (topics outside the map use ``default_partitions``).
    ``sink_parallelism`` of ``None`` or 1 keeps the natural parallelism of the
    input; a larger one is the number of writers, or with ``narrow`` the most there
    may be, which needs no shuffle. The ``max_batch_*`` limits bound one micro-batch of a stream: records of
    a Kafka source, files or bytes of a folder. ``in_waves`` lets several tasks send a topic partition
    in order to a live target, one after another, without such a limit. ``start_after`` drops records up to
    a log position, the mark of a snapshot delivered before. ``zone`` is the target zone of timestamps; ``None`` means the session
    zone. ``router`` and ``partitioner`` replace the topic and partition rules;
    each maps columns to a column, so a replacement stays inside the query plan.
    """

    job_id: str = fixed.JOB_ID
    checkpoint_dir: str | None = None

    host: str = fixed.HOST
    port: int = fixed.PORT
    username: str = fixed.USERNAME
    password: str | None = None
    timezone: str = fixed.TIMEZONE
    start_mode: int = fixed.START_INITIAL
    start_timestamp: int = 0
    start_after: Position | None = None
    databases: str = ""
    tables: str = ""
    include_schema_changes: bool = True
    zone: str | None = None

    brokers: str = fixed.KAFKA_BROKERS
    service_url: str = fixed.PULSAR_SERVICE_URL
    admin_url: str = fixed.PULSAR_ADMIN_URL
    partitions: int | Mapping[str, int] = fixed.KAFKA_PARTITIONS
    default_partitions: int = fixed.KAFKA_PARTITIONS
    sink_parallelism: int | None = None
    narrow: bool = False
    max_batch_records: int | None = None
    max_batch_files: int | None = None
    max_batch_bytes: int | None = None

    key_column: str = "id"
    delete_partition: str = "slot0"
    order: str = "none"
    in_waves: bool = False
    router: Callable[[Column, Column], Column] | None = None
    partitioner: Callable[[Column, Column], Column] | None = None

    def __post_init__(self) -> None:
        check_partitions(self.partitions)
        check_partitions(self.default_partitions)
        for name in ("start_mode", "start_timestamp", "port"):
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, int):
                raise ValueError(f"{name} must be a whole number, got {value!r}")
        if self.sink_parallelism is not None and self.sink_parallelism < 1:
            raise ValueError("sink_parallelism must be at least 1")
        if self.start_mode == fixed.START_TIMESTAMP and self.start_timestamp == 0:
            raise ValueError("start mode 4 needs a start_timestamp in epoch milliseconds")
        if self.order not in ORDERS:
            raise ValueError(f"order must be one of {ORDERS}")
        if self.in_waves and self.order != "partition":
            raise ValueError("in_waves needs order='partition'")
        if self.delete_partition not in DELETE_PARTITIONS:
            raise ValueError(f"delete_partition must be one of {DELETE_PARTITIONS}")

    @property
    def bounded_batches(self) -> bool:
        return any((self.max_batch_records, self.max_batch_files, self.max_batch_bytes))

    def with_(self, **changes) -> Options:
        return replace(self, **changes)

    @classmethod
    def from_mapping(cls, settings: Mapping, **extra) -> Options:
        """Read the nested ``job`` / ``datasource`` / ``sink`` layout of a job file."""
        job = settings.get("job") or {}
        mysql = (settings.get("datasource") or {}).get("mysql") or {}
        sink = settings.get("sink") or {}
        kafka, pulsar = sink.get("kafka") or {}, sink.get("pulsar") or {}
        found = {
            "job_id": job.get("id"),
            "checkpoint_dir": job.get("checkpoint-directory"),
            "host": mysql.get("host"),
            "port": mysql.get("port"),
            "username": mysql.get("username"),
            "password": mysql.get("password"),
            "timezone": mysql.get("timezone"),
            "start_mode": mysql.get("startup_mode"),
            "start_timestamp": mysql.get("startup_timestamp"),
            "databases": mysql.get("databases"),
            "tables": mysql.get("tables"),
            "brokers": kafka.get("brokers"),
            "partitions": kafka.get("partition"),
            "sink_parallelism": kafka.get("parallelism"),
            "service_url": pulsar.get("service-url"),
            "admin_url": pulsar.get("admin-url"),
        }
        texts = {"job_id", "username", "password", "databases", "tables"}
        values = {k: str(v) if k in texts else v for k, v in found.items() if v is not None}
        if values.get("sink_parallelism") == 1 and "order" not in extra:
            warnings.warn("parallelism 1 does not order records; ask for order='partition'", stacklevel=2)
        return cls(**{**values, **extra})
