"""Capture: row changes from a table's rows, from a change log, or from two versions.

All functions return a change frame: the columns ``before``, ``after``,
``source``, ``op``, ``ts_ms`` and ``transaction``.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowrelay import fixed
from rowrelay.functions.position import Position, is_after, position_order
from rowrelay.functions.record import ENVELOPE, source_struct


def last_position(changes: DataFrame, source: str = "source") -> DataFrame:
    """One row, ``sequence``, ``pos`` and ``row``: the end of a bounded log.

    Without grouping columns the struct maximum needs no sort: each task keeps one.
    """
    columns = [c.alias(n) for c, n in zip(position_order(source), ("sequence", "pos", "row"))]
    return changes.agg(F.max(F.struct(*columns)).alias("last")).select("last.*")


def high_water_mark(changes: DataFrame, source: str = "source") -> Position | None:
    """The end of a bounded log as a value for a later start; ``None`` for an empty log."""
    sequence, pos, row = last_position(changes, source).first()
    return None if sequence is None else Position(sequence, pos, row)


def processing_time() -> Column:
    return F.unix_millis(F.current_timestamp())


def snapshot(
    rows: DataFrame,
    db: str,
    table: str,
    *,
    mark: Position,
    ts_ms: Column | None = None,
    processed_ms: Column | None = None,
) -> DataFrame:
    """Every current row as an ``r`` record without a before image.

    A narrow projection: it keeps the input's partitioning and needs no shuffle.
    ``mark`` is the log position the rows were read at.
    """
    now = processing_time()
    image = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.select(
        F.when(F.lit(False), image).alias("before"),
        image.alias("after"),
        source_struct(
            F.lit(db),
            F.lit(table),
            ts_ms=now if ts_ms is None else ts_ms,
            file=F.lit(mark.file),
            pos=F.lit(mark.pos),
            row=F.lit(mark.row),
            snapshot="true",
        ).alias("source"),
        F.lit("r").alias("op"),
        (now if processed_ms is None else processed_ms).cast("bigint").alias("ts_ms"),
        F.lit(None).cast("string").alias("transaction"),
    )


def latest(changes: DataFrame, mark: Position) -> DataFrame:
    """Changes past the end of the log as it was when the job started."""
    return changes.where(is_after(mark))


def since(ts_ms: Column, epoch_ms: int) -> Column:
    return F.coalesce(ts_ms >= epoch_ms, F.lit(True))


def from_timestamp(changes: DataFrame, epoch_ms: int) -> DataFrame:
    """Changes made at the database at or after ``epoch_ms``; undated ones are kept."""
    if epoch_ms == 0:
        raise ValueError("a timestamp start needs a start_timestamp in epoch milliseconds")
    return changes.where(since(F.col("source.ts_ms"), epoch_ms))


def handoff(snapshot_changes: DataFrame, changes: DataFrame, mark: Position) -> DataFrame:
    """Snapshot records, then the changes after its mark: no gap and no repeat."""
    return snapshot_changes.unionByName(latest(changes, mark))


def start(
    mode: int,
    changes: DataFrame,
    *,
    mark: Position,
    snapshot_changes: DataFrame | None = None,
    epoch_ms: int = 0,
) -> DataFrame:
    """Choose the start point by mode number, when the plan is built.

    0 is a snapshot followed by live changes, 4 starts at a time; every other
    number starts at the end of the log.
    """
    if mode == fixed.START_INITIAL:
        if snapshot_changes is None:
            raise ValueError("start mode 0 needs the table's snapshot")
        return handoff(snapshot_changes, changes, mark)
    if mode == fixed.START_TIMESTAMP:
        return from_timestamp(changes, epoch_ms)
    if mode in (fixed.START_EARLIEST, fixed.START_SPECIFIC):
        warnings.warn(f"start mode {mode} is treated as latest", stacklevel=2)
    return latest(changes, mark)


def diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    db: str,
    table: str,
    *,
    mark: Position,
    ts_ms: Column | None = None,
    processed_ms: Column | None = None,
) -> DataFrame:
    """The changes that turn one version of a table into another.

    A full outer join on the primary key: one exchange per side, none for a side
    already bucketed on the key. Primary keys are unique, so no key is hot.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("both versions need the same columns")
    columns = [F.col(f"`{c}`") for c in old.columns]
    names = [f"_key{i}" for i in range(len(keys))]
    key_columns = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]
    before = old.select(*key_columns, F.struct(*columns).alias("before"))
    after = new.select(*key_columns, F.struct(*columns).alias("after"))

    now = processing_time()
    op = (
        F.when(F.col("before").isNull(), "c")
        .when(F.col("after").isNull(), "d")
        .when(~F.col("before").eqNullSafe(F.col("after")), "u")
    )
    return (
        before.join(after, names, "full_outer")
        .select(
            "before",
            "after",
            source_struct(
                F.lit(db),
                F.lit(table),
                ts_ms=now if ts_ms is None else ts_ms,
                file=F.lit(mark.file),
                pos=F.lit(mark.pos),
                row=F.lit(mark.row),
            ).alias("source"),
            op.alias("op"),
            (now if processed_ms is None else processed_ms).cast("bigint").alias("ts_ms"),
            F.lit(None).cast("string").alias("transaction"),
        )
        .where(F.col("op").isNotNull())
        .select(*ENVELOPE)
    )
