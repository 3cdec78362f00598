"""A table's snapshot in chunks, between changes, that goes on where it was stopped.

Each chunk is a key range with two marks: the end of the log before its rows are read
and after. A row that changed between the marks may have been read before or after the
change, so it is left out: its change is in the log after the low mark, whole. The
others are as they were at the low mark. A change is live for its row's chunk if it
lies after that chunk's low mark, so no row is missed and none is told twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.functions.position import BEFORE_ALL, Position, is_after
from rowrelay.functions.record import parse
from rowrelay.options import Options
from rowrelay.plans.delivery import routed_records, run_routed, snapshot_records
from rowrelay.sinks.targets import Target
from rowrelay.sources.changelog import check_start
from rowrelay.sources.logindex import LogIndex
from rowrelay.streaming.folders import file_system, staged

#: A plan holds a condition for each chunk.
MOST_CHUNKS = 1000

_ENTRY = "number int, sequence bigint, pos bigint, row int, high_sequence bigint, high_pos bigint, high_row int"


@dataclass(frozen=True)
class Chunk:
    """A range of keys, ``lower`` included and ``upper`` not, open where ``None``, and its marks."""

    number: int
    lower: int | None
    upper: int | None
    low: Position | None = None
    high: Position | None = None

    def holds(self, key: Column) -> Column:
        """Whether a key is in the range; rows without a key are in the first one."""
        above = F.lit(True) if self.lower is None else key >= self.lower
        below = F.lit(True) if self.upper is None else key < self.upper
        inside = F.coalesce(above & below, F.lit(False))
        return inside | key.isNull() if self.lower is None else inside


@dataclass(frozen=True)
class ChunkedTable:
    """A table to capture in chunks: how to read a range of it, and where to cut.

    ``read`` gives the rows of a chunk as they are when it is called; for a database it
    is a read with the chunk's condition. ``cuts`` are the first keys of all chunks but
    the first, whole numbers in ascending order, such as quantiles of the key.
    """

    read: Callable[[Chunk], DataFrame]
    cuts: Sequence[int]
    sql_types: Mapping[str, str] = field(default_factory=dict)


class Ledger:
    """The chunks of a table's snapshot, kept in a folder: the ranges, and each chunk that was delivered."""

    def __init__(self, spark: SparkSession, place: str):
        self.spark, self.place = spark, place

    def _written(self, name: str) -> bool:
        system, there = file_system(self.spark, f"{self.place}/{name}/_SUCCESS")
        return system.exists(there)

    def ranges(self, cuts: Sequence[int]) -> list[Chunk]:
        """The chunks as they were first planned; the table may have grown since."""
        if not self._written("ranges"):
            if list(cuts) != sorted(set(cuts)) or len(cuts) >= MOST_CHUNKS:
                raise ValueError(f"cuts must ascend and be fewer than {MOST_CHUNKS}")
            row = self.spark.range(1, numPartitions=1).select(F.lit(json.dumps(list(map(int, cuts)))).alias("cuts"))
            row.write.mode("overwrite").json(f"{self.place}/ranges")
        cuts = json.loads(self.spark.read.schema("cuts string").json(f"{self.place}/ranges").first().cuts)
        return [Chunk(i, lower, upper) for i, (lower, upper) in enumerate(zip([None, *cuts], [*cuts, None]))]

    def marked(self, chunk: Chunk) -> Chunk | None:
        """The chunk with its marks, if it was delivered."""
        if not self._written(f"{chunk.number}"):
            return None
        row = self.spark.read.schema(_ENTRY).json(f"{self.place}/{chunk.number}").first()
        return Chunk(chunk.number, chunk.lower, chunk.upper, Position(*row[1:4]), Position(*row[4:7]))

    def add(self, chunk: Chunk) -> None:
        values = [chunk.number, chunk.low.sequence, chunk.low.pos, chunk.low.row, chunk.high.sequence, chunk.high.pos, chunk.high.row]
        names = [f.split()[0] for f in _ENTRY.split(", ")]
        row = self.spark.range(1, numPartitions=1).select(*[F.lit(v).alias(n) for v, n in zip(values, names)])
        row.write.mode("overwrite").json(f"{self.place}/{chunk.number}")


def record_key(records: DataFrame) -> Column:
    """The id of a parsed record's row; a deleted row has it in the old image only."""
    return F.coalesce(F.col("row_id"), F.col("before_id"))


def _own(texts: DataFrame, name: str, opts: Options) -> DataFrame:
    db, table = name.split(".", 1)
    records = parse(texts, key_column=opts.key_column, position=True, before=True)
    return records.where((F.col("db") == db) & (F.col("table") == table) & F.col("op").isNotNull())


def unchanged(rows: DataFrame, index: LogIndex, name: str, opts: Options, low: Position, high: Position) -> DataFrame:
    """The rows without those that changed after ``low`` and up to ``high``.

    Only the log's files between the marks are read, and once: the keys that changed are
    written to the session's folder. A truncate between them ends all rows.
    """
    texts = index.read_after(low, high)
    between = _own(texts, name, opts).where(is_after(low, "") & ~is_after(high, ""))
    keys = staged(between.select(record_key(between).alias("_changed"), F.col("op").alias("_op")).distinct(), "changed")
    key = F.col(f"`{opts.key_column}`").cast("decimal(38,0)")
    if not keys.where("_op = 't'").isEmpty():
        return rows.limit(0)
    return rows.join(keys.drop("_op"), key == F.col("_changed"), "left_anti")


def snapshot_chunks(index: LogIndex, opts: Options, target: Target, name: str, table: ChunkedTable, place: str) -> list[Chunk]:
    """Deliver the table's rows chunk by chunk; returns the chunks with their marks.

    A chunk is entered in the ledger when it was delivered. Called again, after a loss of
    the driver, the chunks in the ledger are left out, and the one that was begun is read
    anew with new marks (at least once). The rows of a chunk are written to the shared
    folder before its high mark is taken, because a second read could see other rows.
    """
    check_start(opts)
    spark, ledger, done = index.spark, Ledger(index.spark, place), []
    db, table_name = name.split(".", 1)
    for chunk in ledger.ranges(table.cuts):
        old = ledger.marked(chunk)
        if old is None:
            low = index.end() or BEFORE_ALL
            rows = staged(table.read(chunk), "chunk")
            high = index.end() or BEFORE_ALL
            left = unchanged(rows, index, name, opts, low, high)
            records = snapshot_records(left, opts, db, table_name, low, table.sql_types)
            run_routed(routed_records(records, opts), opts, target)
            old = Chunk(chunk.number, chunk.lower, chunk.upper, low, high)
            ledger.add(old)
        done.append(old)
    return done


def _later(chunks: Sequence[Chunk], key: Column) -> Column:
    """Whether a record lies after the low mark of its key's chunk, as a tree of conditions."""
    if len(chunks) == 1:
        return is_after(chunks[0].low, "")
    half = len(chunks) // 2
    below = F.coalesce(key < chunks[half].lower, F.lit(True))
    return F.when(below, _later(chunks[:half], key)).otherwise(_later(chunks[half:], key))


def live(records: DataFrame, snapshots: Mapping[str, Sequence[Chunk]]) -> DataFrame:
    """The parsed records that follow the snapshots, ``db.table`` to its chunks.

    A record of a captured table is kept after its chunk's low mark; a truncate, which has
    no row, and any other record after the first low mark of all.
    """
    start = min((c.low for own in snapshots.values() for c in own), default=BEFORE_ALL)
    kept = is_after(start, "")
    for name, chunks in snapshots.items():
        db, table = name.split(".", 1)
        own = (F.col("db") == db) & (F.col("table") == table) & (F.col("row_id").isNotNull() | F.col("before_id").isNotNull())
        last = max(c.low for c in chunks)
        later = F.when(is_after(last, ""), True).otherwise(_later(chunks, record_key(records)))
        kept = F.when(F.coalesce(own, F.lit(False)), later).otherwise(kept)
    return records.where(kept)


def capture_in_chunks(
    index: LogIndex, opts: Options, target: Target, tables: Mapping[str, ChunkedTable], place: str
) -> None:
    """Deliver the tables' snapshots in chunks, then the log's changes after them, as far as it goes now.

    A change is parsed once, for its chunk's mark and for its route.
    """
    found = {n: snapshot_chunks(index, opts, target, n, t, f"{place}/{n}") for n, t in tables.items()}
    start = min((c.low for own in found.values() for c in own), default=BEFORE_ALL)
    records = parse(index.read_after(start), key_column=opts.key_column, position=True, before=True)
    run_routed(routed_records(live(records, found), opts), opts, target)
