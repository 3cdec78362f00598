"""From record texts to routed records, and the batch form of a delivery job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowrelay import fixed
from rowrelay.functions.position import Position, is_after
from rowrelay.functions.record import encode, encoded_value, id_number, parse
from rowrelay.operators.capture import since, snapshot
from rowrelay.operators.convert import convert_row
from rowrelay.operators.filters import include
from rowrelay.operators.ordering import gather, narrow, spread, write_ranges
from rowrelay.operators.routing import route
from rowrelay.options import Options
from rowrelay.sinks.targets import Target
from rowrelay.sources.changelog import check_start

OPERATIONS = ("r", "c", "u", "d")


def deliveries(wire: DataFrame, opts: Options = Options(), position: bool = False) -> DataFrame:
    """Parse, filter and route record texts (column ``value``): one stage, no shuffle.

    The result carries the untouched text and the columns ``db``, ``table``,
    ``op``, ``row_id``, ``topic`` and ``partition``, and the log position if asked
    for or needed for ordering. The same plan serves batch and streaming input.
    """
    timed = opts.start_mode == fixed.START_TIMESTAMP
    records = parse(
        wire,
        key_column=opts.key_column,
        position=position or timed or opts.start_after is not None or opts.order == "partition",
        before=opts.delete_partition == "before_id",
    )
    return routed_records(records, opts)


def routed_records(records: DataFrame, opts: Options = Options()) -> DataFrame:
    """Filter and route parsed records, such as those of a :class:`ParsedLog`.

    They need their position for a later start, and their old id if deletes go by it.
    """
    if opts.start_mode == fixed.START_TIMESTAMP:
        records = records.where(since(F.col("source_ts_ms"), opts.start_timestamp))
    if opts.start_after is not None:
        records = records.where(is_after(opts.start_after, ""))
    records = include(records, opts.databases, opts.tables, opts.include_schema_changes)
    return route(records, opts)


def table_snapshot(
    rows: DataFrame,
    opts: Options,
    db: str,
    table: str,
    mark: Position,
    sql_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table's current rows as record texts, converted by their SQL types.

    Deliver them with :func:`run_batch` and follow with a stream whose options have
    ``start_after=mark``. Take the mark before reading the rows: a change made in
    between is then delivered again, never missed, and a replay ranks it last.
    """
    return encode(snapshot(convert_row(rows, sql_types, opts.zone), db, table, mark=mark))


def snapshot_records(
    rows: DataFrame,
    opts: Options,
    db: str,
    table: str,
    mark: Position,
    sql_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """As :func:`table_snapshot`, with the columns that a parse of the texts would give.

    The rows are at hand, so no text is parsed. As there, a row without its id fails the job.
    """
    changes = snapshot(convert_row(rows, sql_types, opts.zone), db, table, mark=mark)
    key = opts.key_column
    named = key in changes.schema["after"].dataType.names
    text = F.col("after").getField(key).cast("string") if named else F.lit(None).cast("string")
    return changes.select(
        encoded_value(),
        *[F.col(f"source.{c}").alias(c) for c in ("db", "table", "file", "pos", "row")],
        F.col("source.ts_ms").alias("source_ts_ms"),
        "op",
        id_number(text, key).alias("row_id"),
        F.lit(None).cast("decimal(38,0)").alias("before_id"),
    )


def progress_columns() -> list[Column]:
    """Counters for ``DataFrame.observe``: all records, each operation, schema changes."""
    ops = [F.count_if(F.col("op") == op).alias(f"op_{op}") for op in OPERATIONS]
    return [
        F.count(F.lit(1)).alias("records"),
        *ops,
        F.count_if(F.col("op").isNull()).alias("schema_changes"),
        F.count_if(F.col("topic") == fixed.FALLBACK_TOPIC).alias("fallback"),
    ]


def run_batch(wire: DataFrame, opts: Options, target: Target) -> None:
    """Deliver a bounded input. A latest start is refused without its mark.

    In order, the input is cut into position ranges, so no topic partition has to
    fit one task. A live target needs one writer per topic partition instead;
    that is only sound for bounded pieces, so it is left to a stream with
    ``available_now=True`` and a rate limit.
    """
    check_start(opts)
    run_routed(deliveries(wire, opts), opts, target)


def run_routed(routed: DataFrame, opts: Options, target: Target) -> None:
    """As :func:`run_batch`, of records that were parsed and routed already."""
    parallelism = opts.sink_parallelism if (opts.sink_parallelism or 1) > 1 else None
    if opts.order == "partition" and target.single_writer:
        raise ValueError("ordered delivery to a live target runs as a stream")
    if opts.order == "partition":
        write_ranges(routed, target.write, parallelism)
        return
    arrange = {"none": narrow if opts.narrow else spread, "gathered": gather}[opts.order]
    target.write(arrange(routed, parallelism))
