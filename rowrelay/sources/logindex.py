"""An index of a log's files, so that a start reads no file that lies before it.

The index is a table next to the job: for each file of the log the first and the last
position and time of its records. Files of a log don't change, so each is parsed for
the index once; later calls parse only the files that have come since.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.functions.position import Position, position_order
from rowrelay.functions.record import parse
from rowrelay.sources.changelog import read_text
from rowrelay.streaming.folders import file_system

_AT = "struct<sequence: bigint, pos: bigint, row: int>"
INDEX = f"file string, records bigint, unplaced bigint, undated bigint, first {_AT}, last {_AT}, first_ms bigint, last_ms bigint"


def _entries(spark: SparkSession, files: list[str], key_column: str) -> DataFrame:
    """A row for each file; a file's records are added up in the tasks that read its parts."""
    lines = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("_file"))
    records = parse(lines, key_column=key_column, position=True, keep=("_file",))
    sequence, pos, row = position_order("")
    placed = sequence.isNotNull() & pos.isNotNull()
    at = F.when(placed, F.struct(sequence.alias("sequence"), pos.alias("pos"), F.coalesce(row, F.lit(0)).alias("row")))
    return records.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(~placed).alias("unplaced"),
        F.count_if(F.col("source_ts_ms").isNull()).alias("undated"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
        F.min("source_ts_ms").alias("first_ms"),
        F.max("source_ts_ms").alias("last_ms"),
    )


class LogIndex:
    """The index of a folder of record texts, kept in the folder ``place``.

    The driver holds the names of the files, as it does for any read of the folder; the
    entries stay a table.
    """

    def __init__(self, spark: SparkSession, log: str, place: str, key_column: str = "id"):
        self.spark, self.log, self.place, self.key_column = spark, log, place, key_column

    def _indexed(self) -> DataFrame:
        system, there = file_system(self.spark, self.place)
        if not system.exists(there):
            return self.spark.createDataFrame([], INDEX)
        # Entries of two jobs that indexed a file at once are the same.
        parts = [str(s.getPath()) for s in system.listStatus(there)]
        whole = [p for p in parts if system.exists(file_system(self.spark, f"{p}/_SUCCESS")[1])]
        if not whole:
            return self.spark.createDataFrame([], INDEX)
        return self.spark.read.schema(INDEX).parquet(*whole).dropDuplicates(["file"])

    def refresh(self) -> DataFrame:
        """The entries of all files the log has now; files without an entry are parsed first.

        Empty files have an entry, too, so that they aren't looked at again.
        """
        # A file of a system without a host is listed as system:///file and read as system:/file.
        names = [re.sub(r"^(\w+):/{3}(?!/)", r"\1:/", n) for n in read_text(self.spark, self.log).inputFiles()]
        now = self.spark.createDataFrame([(n,) for n in names], "file string")
        known = self._indexed()
        fresh = [r.file for r in now.join(known, "file", "left_anti").collect()]
        if fresh:
            found = _entries(self.spark, fresh, self.key_column)
            every = self.spark.createDataFrame([(n,) for n in fresh], "file string")
            entries = every.join(found, "file", "left").na.fill(0, ["records", "unplaced", "undated"])
            entries.coalesce(1).write.parquet(f"{self.place}/{uuid.uuid4().hex}")
        return self._indexed().join(now, "file", "left_semi")

    def end(self) -> Position | None:
        """The last position of the log; ``None`` if no record has one."""
        last = self.refresh().agg(F.max("last").alias("last")).first().last
        return None if last is None else Position(*last)

    def _read(self, wanted: DataFrame) -> DataFrame:
        files = [r.file for r in wanted.select("file").collect()]
        if not files:
            return self.spark.createDataFrame([], "value string")
        return self.spark.read.text(files)

    def read_after(self, mark: Position, until: Position | None = None) -> DataFrame:
        """The texts of the files that reach past ``mark``, and begin no later than ``until``.

        Records at or before the mark, in files that have later ones, are still there, as
        are records that don't say where they come from.
        """
        place = F.struct(F.lit(mark.sequence).cast("bigint"), F.lit(mark.pos).cast("bigint"), F.lit(mark.row).cast("int"))
        wanted = (F.col("unplaced") > 0) | (F.col("last") > place)
        if until is not None:
            end = F.struct(F.lit(until.sequence).cast("bigint"), F.lit(until.pos).cast("bigint"), F.lit(until.row).cast("int"))
            wanted = wanted & ((F.col("unplaced") > 0) | (F.col("first") <= end))
        return self._read(self.refresh().where(wanted))

    def read_since(self, epoch_ms: int) -> DataFrame:
        """The texts of the files with a record made at or after ``epoch_ms``, or an undated one."""
        return self._read(self.refresh().where((F.col("undated") > 0) | (F.col("last_ms") >= epoch_ms)))
