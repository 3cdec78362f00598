"""A whole capture job: a start mode, the tables' snapshot, and the live changes."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowrelay import fixed
from rowrelay.functions.offsets import Offsets
from rowrelay.functions.position import BEFORE_ALL, Position
from rowrelay.options import Options
from rowrelay.plans.delivery import run_batch, table_snapshot
from rowrelay.sinks.targets import Target
from rowrelay.sources.logs import Log, TextLog
from rowrelay.streaming.folders import file_system
from rowrelay.streaming.job import checkpoint_location, start_stream


@dataclass(frozen=True)
class Table:
    """A table to capture: its rows, and its declared SQL types by column."""

    rows: DataFrame
    sql_types: Mapping[str, str] = field(default_factory=dict)


def _written(spark: SparkSession, path: str) -> bool:
    system, there = file_system(spark, f"{path}/_SUCCESS")
    return system.exists(there)


def _log(log: str | Log) -> Log:
    return TextLog(log) if isinstance(log, str) else log


def start_mark(spark: SparkSession, log: str | Log, opts: Options, place: str) -> Position | Offsets:
    """The end of the log when the job was first started, remembered in ``place``."""
    path, log = f"{place}-mark", _log(log)
    if not _written(spark, path):
        log.store(spark, path, log.end(spark, opts, place))
    return log.stored(spark, path)


def run_job(
    spark: SparkSession,
    log: str | Log,
    opts: Options,
    target: Target,
    tables: Mapping[str, Table] | None = None,
    *,
    available_now: bool = False,
    trigger: str = fixed.TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Run a job by its start mode over a log; returns the live query.

    ``log`` is a folder of record texts or a log object: :class:`KafkaLog`,
    :class:`MessageFiles`, or another with their methods.

    Mode 0 takes the end of the log as its mark, delivers the rows of ``tables``
    (``db.table`` to :class:`Table`), and then the changes after the mark. Mode 4
    delivers the changes from ``start_timestamp`` on. Every other mode delivers what
    comes after the end of the log. Include lists hold for tables as for changes.

    The mark is a log position, or an offset for each partition of a log of messages.
    Rows captured by offsets carry the place before every log, so every change that
    follows ranks after them.

    The mark, and that the snapshot was delivered, are remembered next to the job's
    checkpoint. A job started again goes on from there: with the same mark, and with
    the snapshot only if it was not delivered whole (at least once).
    """
    log, place = _log(log), checkpoint_location(spark, opts)
    mark = None
    if opts.start_mode != fixed.START_TIMESTAMP:
        if opts.start_mode in (fixed.START_EARLIEST, fixed.START_SPECIFIC):
            warnings.warn(f"start mode {opts.start_mode} is treated as latest", stacklevel=2)
        if opts.start_mode == fixed.START_INITIAL and not tables:
            raise ValueError("start mode 0 needs the tables to capture")
        mark = start_mark(spark, log, opts, place)
    if opts.start_mode == fixed.START_INITIAL:
        read_at = mark if isinstance(mark, Position) else BEFORE_ALL
        for name, table in tables.items():
            done = f"{place}-snapshot/{name}"
            if not _written(spark, done):
                db, table_name = name.split(".", 1)
                rows = table_snapshot(table.rows, opts, db, table_name, read_at, table.sql_types)
                # A snapshot's records share one position, so any order is theirs.
                live = opts.order == "partition" and target.single_writer
                run_batch(rows, opts.with_(order="none", in_waves=False) if live else opts, target)
                log.store(spark, done, mark)
    wire, opts = log.follow(spark, opts, mark)
    return start_stream(wire, opts, target, available_now=available_now, trigger=trigger)
