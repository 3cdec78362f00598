"""The current rows of captured tables, kept in buckets that changes are merged into.

A row's bucket is a hash of its table and key. A batch of changes rewrites only the
buckets it touches, into new files; a manifest names each bucket's files, and a version
takes effect by one rename of its manifest. Readers see a whole version or the one
before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.functions.position import position_order
from rowrelay.operators.replay import newest, no_truncate, row_key
from rowrelay.streaming.folders import file_system, staged

PLACE = ("_log", "_pos", "_row")


class BucketedState:
    """Rows of the tables of one log in the folder ``place``; ``image`` is the row image's DDL fields.

    The number of buckets is fixed by the first merge; a bucket should hold what one task
    can sort. There must be one writer at a time, as a streaming job is. Files of older
    versions stay, for readers that still use them.
    """

    def __init__(self, spark: SparkSession, place: str, image: str, keys: Sequence[str] = ("id",), buckets: int = 64):
        self.spark, self.place, self.image, self.keys, self.buckets = spark, place, image, list(keys), buckets

    def _manifest(self) -> dict:
        system, there = file_system(self.spark, f"{self.place}/versions")
        names = [s.getPath().getName() for s in system.listStatus(there)] if system.exists(there) else []
        versions = [int(n) for n in names if n.isdigit()]
        if not versions:
            return {"version": -1, "batch": -1, "buckets": self.buckets, "files": {}}
        return json.loads(self.spark.read.text(f"{self.place}/versions/{max(versions)}").first().value)

    def _commit(self, manifest: dict) -> None:
        hidden = f"{self.place}/versions/_{uuid.uuid4().hex}"
        row = self.spark.range(1, numPartitions=1).select(F.lit(json.dumps(manifest)).alias("value"))
        row.write.text(hidden)
        system, there = file_system(self.spark, f"{self.place}/versions/{manifest['version']}")
        if system.exists(there) or not system.rename(file_system(self.spark, hidden)[1], there):
            raise RuntimeError(f"version {manifest['version']} was written by another job")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("db", "table", *self._names()), F.lit(buckets)).cast("int")

    def _names(self) -> list[str]:
        return [f"_key_{k}" for k in self.keys]

    def _read(self, files: Sequence[str]) -> DataFrame:
        image = self.spark.createDataFrame([], f"after struct<{self.image}>").schema["after"].dataType
        keys = ", ".join(f"`_key_{k}` {image[k].dataType.simpleString()}" for k in self.keys)
        schema = f"db string, `table` string, {keys}, _log bigint, _pos bigint, _row int, op string, after struct<{self.image}>"
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.place}/{f}" for f in files])

    def read(self) -> DataFrame:
        """``db``, ``table`` and ``after`` of the rows that exist, as of the last version."""
        rows = self._read(sorted(self._manifest()["files"].values()))
        return rows.where(F.col("op") != "d").select("db", "table", "after")

    def files(self) -> dict[int, str]:
        """The folder of each bucket, below ``place``."""
        return {int(b): f for b, f in self._manifest()["files"].items()}

    def merge(self, changes: DataFrame, batch: int) -> int:
        """Merge a batch of decoded changes; returns how many buckets were rewritten.

        The record with the last position of a row counts, whatever batch it comes in, so
        records may be delivered again and batches overlap. Deleted rows are kept as such,
        or an older record that comes later would bring them back. A batch that a version
        has already is left out. Schema changes take no part; a truncate fails the job.
        """
        manifest = self._manifest()
        if batch <= manifest["batch"]:
            return 0
        rows = changes.where(F.col("op").isNotNull()).select(
            F.col("source.db").alias("db"),
            F.col("source.table").alias("table"),
            *[row_key(k).alias(n) for k, n in zip(self.keys, self._names())],
            *[c.alias(n) for c, n in zip(position_order(), PLACE)],
            no_truncate(F.col("op")).alias("op"),
            "after",
        )
        order = [F.col(c) for c in PLACE]
        fresh = newest(rows, ["db", "table", *self._names()], order)
        fresh = staged(fresh.withColumn("bucket", self._bucket(manifest["buckets"])), "merge")
        touched = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())
        files = dict(manifest["files"])
        if touched:
            old = self._read([files[str(b)] for b in touched if str(b) in files])
            old = old.withColumn("bucket", self._bucket(manifest["buckets"]))
            # One exchange by bucket serves the ranking and gives each bucket one file.
            both = old.unionByName(fresh).repartition("bucket")
            last = newest(both, ["bucket", "db", "table", *self._names()], order)
            name = f"data/{batch}-{uuid.uuid4().hex}"
            last.write.partitionBy("bucket").parquet(f"{self.place}/{name}")
            files |= {str(b): f"{name}/bucket={b}" for b in touched}
        self._commit({"version": manifest["version"] + 1, "batch": batch, "buckets": manifest["buckets"], "files": files})
        return len(touched)
