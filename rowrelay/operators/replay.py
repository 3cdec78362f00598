"""Replay: the current rows of a table from its change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowrelay.functions.position import position_order
from rowrelay.streaming.folders import staged


def row_key(name: str) -> Column:
    """A deleted row has its key in the old image only."""
    return F.coalesce(F.col(f"after.`{name}`"), F.col(f"before.`{name}`"))


def newest(rows: DataFrame, keys: Sequence[str], position: Sequence[Column]) -> DataFrame:
    """The row with the last position of each key.

    Filtering on ``row_number() = 1`` lets Spark keep one record per key in each
    map task before the shuffle (WindowGroupLimit), so a key with very many changes
    does not collect in one task. Repeated delivery of a record changes nothing,
    because records are ranked by position.
    """
    order = [c.desc() for c in position]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def no_truncate(op: Column) -> Column:
    """The operation; a truncate has no row image, so it can't be replayed row by row."""
    refused = F.raise_error(F.lit("a truncate can't be replayed; replay the records after it"))
    return F.when(op == "t", refused.cast("string")).otherwise(op)


def _past_truncates(rows: DataFrame, place: Sequence[Column]) -> DataFrame:
    """The rows that no truncate of their table ended; ``db``, ``table`` and ``op`` are read.

    There is one end per truncated table, so the join is a broadcast unless a great
    many tables are truncated.
    """
    at = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(place)])
    ends = rows.where(F.col("op") == "t").groupBy("db", "table").agg(F.max(at).alias("_end"))
    ends = ends.select(F.col("db").alias("_db"), F.col("table").alias("_table"), "_end")
    same = F.col("db").eqNullSafe(F.col("_db")) & F.col("table").eqNullSafe(F.col("_table"))
    left = rows.where(F.col("op") != "t").join(ends, same, "left")
    return left.where(F.col("_end").isNull() | (at > F.col("_end"))).drop("_db", "_table", "_end")


def last_changes(changes: DataFrame, keys: Sequence[str] = ("id",), truncates: bool = False) -> DataFrame:
    """The last change of each row: ``db``, ``table``, the keys, ``op`` and ``after``.

    Records without an operation are schema changes and do not take part. With
    ``truncates`` the changes before the last truncate of their table are left out,
    which reads the log twice; without, a truncate fails the job.
    """
    place = ("_log", "_pos", "_row")
    rows = changes.where(F.col("op").isNotNull()).select(
        F.col("source.db").alias("db"),
        F.col("source.table").alias("table"),
        *[row_key(k).alias(f"_key_{k}") for k in keys],
        *[c.alias(n) for c, n in zip(position_order(), place)],
        (F.col("op") if truncates else no_truncate(F.col("op"))).alias("op"),
        "after",
    )
    if truncates:
        rows = _past_truncates(rows, [F.col(c) for c in place])
    names = ["db", "table", *[f"_key_{k}" for k in keys]]
    return newest(rows, names, [F.col(c) for c in place]).drop(*place)


def replay_records(records: DataFrame, truncates: bool = False) -> DataFrame:
    """The last record of each row that still exists, for any mix of tables.

    Works on records parsed with ``position`` and ``before``; the texts stay as they
    are, so no table's columns need to be known. ``truncates`` as for ``last_changes``.
    """
    rows = records.where(F.col("op").isNotNull()).withColumn(
        "_key", F.coalesce("row_id", "before_id")
    )
    if truncates:
        rows = _past_truncates(rows, position_order(""))
    else:
        rows = rows.withColumn("op", no_truncate(F.col("op")))
    last = newest(rows, ("db", "table", "_key"), position_order(""))
    return last.where(F.col("op") != "d").drop("_key")


def replay(changes: DataFrame, keys: Sequence[str] = ("id",), truncates: bool = False) -> DataFrame:
    """Columns ``db``, ``table`` and ``after``: the last image of each row that still exists."""
    return last_changes(changes, keys, truncates).where(F.col("op") != "d").select("db", "table", "after")


def apply_changes(
    rows: DataFrame, changes: DataFrame, keys: Sequence[str], db: str, table: str
) -> DataFrame:
    """The rows of ``db.table`` after its ``changes``, all of them later than the rows.

    Changes of other tables in the same log are left out. The last changes are written
    to the session's folder, because they are read twice: to drop old images and to
    add new ones. Rows without a change pass through an anti join, so a few changes to a huge
    table are joined by broadcast (chosen by Spark from the size it measures) and
    the table itself is not shuffled.
    """
    own = (F.col("source.db") == db) & (F.col("source.table") == table)
    last = staged(last_changes(changes.where(own), keys), "last-changes")
    same = [F.col(f"_old.`{k}`") == F.col(f"_last.`_key_{k}`") for k in keys]
    kept = rows.alias("_old").join(last.alias("_last"), same, "left_anti")
    return kept.unionByName(last.where(F.col("op") != "d").select("after.*"))
