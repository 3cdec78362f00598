"""The change record: its structs, its JSON text, and the fields read back from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = ("before", "after", "source", "op", "ts_ms", "transaction")
FAIL_FAST = {"mode": "FAILFAST"}
KEEP_NULLS = {"ignoreNullFields": "false"}

POSITION_FIELDS = "file: string, pos: bigint, row: int, ts_ms: bigint"


def source_struct(
    db: Column,
    table: Column,
    *,
    ts_ms: Column,
    file: Column,
    pos: Column,
    row: Column | None = None,
    snapshot: str = "false",
    server_id: int = 1,
) -> Column:
    """Where a change came from: routing names, log position and time of change."""
    return F.struct(
        F.lit("1.0").alias("version"),
        F.lit("mysql").alias("connector"),
        F.lit("mysql_binlog_source").alias("name"),
        ts_ms.cast("bigint").alias("ts_ms"),
        F.lit(snapshot).alias("snapshot"),
        db.cast("string").alias("db"),
        F.lit(None).cast("string").alias("sequence"),
        table.cast("string").alias("table"),
        F.lit(server_id).cast("bigint").alias("server_id"),
        F.lit(None).cast("string").alias("gtid"),
        file.cast("string").alias("file"),
        pos.cast("bigint").alias("pos"),
        (F.lit(0) if row is None else row).cast("int").alias("row"),
        F.lit(None).cast("bigint").alias("thread"),
        F.lit(None).cast("string").alias("query"),
    )


def encoded_value() -> Column:
    """The JSON text of a change frame's row, in ``value``."""
    return F.to_json(F.struct(*ENVELOPE), KEEP_NULLS).alias("value")


def encode(changes: DataFrame) -> DataFrame:
    """Change frame (the ``ENVELOPE`` columns) to one JSON text per row, nulls written."""
    return changes.select(encoded_value())


def decode(wire: DataFrame, image: str) -> DataFrame:
    """JSON texts back to a typed change frame; ``image`` is the row image's DDL fields."""
    schema = (
        f"struct<before: struct<{image}>, after: struct<{image}>, source: struct<version: string, "
        "connector: string, name: string, ts_ms: bigint, snapshot: string, db: string, "
        "sequence: string, table: string, server_id: bigint, gtid: string, file: string, "
        "pos: bigint, row: int, thread: bigint, query: string>, op: string, ts_ms: bigint, "
        "transaction: string>"
    )
    return wire.select(F.inline(F.array(F.from_json("value", schema, FAIL_FAST))))


def id_number(text: Column, name: str) -> Column:
    """An id as a whole number; a fractional or exponent form is cut toward zero.

    An id of more than 38 digits, or 28 before a fraction or exponent, or one that is
    no number, fails the job with an error that names it.
    """
    plain = text.try_cast("decimal(38,0)")
    cut = text.try_cast("decimal(38,10)")
    cut = F.when(cut < 0, F.ceil(cut)).otherwise(F.floor(cut)).cast("decimal(38,0)")
    number = F.when(text.rlike("[.eE]"), cut).otherwise(plain)
    missing = F.raise_error(F.lit(f"change record without '{name}' in its row image"))
    unfit = F.raise_error(F.concat(F.lit(f"'{name}' is no number of at most 38 digits: "), text))
    empty = F.coalesce(text, F.lit("")) == ""
    return F.when(empty, missing.cast("decimal(38,0)")).when(number.isNull(), unfit.cast("decimal(38,0)")).otherwise(number)


def parse(
    wire: DataFrame,
    *,
    key_column: str = "id",
    position: bool = False,
    before: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Read the routing fields of each JSON text, parsing it once.

    Adds ``db``, ``table``, ``op`` and ``row_id`` (null without a row image) to
    ``value``; ``position`` adds ``file``, ``pos``, ``row`` and ``source_ts_ms``;
    ``before`` adds ``before_id``. ``keep`` names further input columns to carry.

    The struct is unpacked by a generator rather than by a projection: Catalyst
    moves later filters below a projection and would then parse every text twice.
    Malformed text, an empty text, a record without ``source`` and a row image
    without its id all fail the job.
    """
    quoted = f"`{key_column}`"
    source = "db: string, table: string" + (f", {POSITION_FIELDS}" if position else "")
    fields = f"source: struct<{source}>, after: struct<{quoted}: string>, op: string"
    if before:
        fields += f", before: struct<{quoted}: string>"
    record = F.from_json("value", f"struct<{fields}>", FAIL_FAST)
    parsed = wire.select("value", *keep, F.inline(F.array(record)))

    no_source = F.raise_error(F.lit("change record without source"))
    db = F.when(F.col("source").isNull(), no_source.cast("string")).otherwise(F.col("source.db"))
    after_id = F.col("after").getField(key_column)
    columns = [
        F.col("value"),
        *[F.col(c) for c in keep],
        db.alias("db"),
        F.col("source.table").alias("table"),
        F.col("op"),
        F.when(F.col("after").isNotNull(), id_number(after_id, key_column)).alias("row_id"),
    ]
    if position:
        columns += [F.col(f"source.{c}").alias(c) for c in ("file", "pos", "row")]
        columns += [F.col("source.ts_ms").alias("source_ts_ms")]
    if before:
        before_id = F.col("before").getField(key_column)
        columns += [
            F.when(F.col("before").isNotNull(), id_number(before_id, key_column)).alias("before_id")
        ]
    return parsed.select(*columns)
