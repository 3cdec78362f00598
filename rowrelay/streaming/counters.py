"""Counters of a job over its whole life, kept next to its checkpoint.

There is a small file for each of the last micro-batches with the totals up to it. A
micro-batch that is run again starts from the totals before it and writes its file anew,
so it counts once; that holds for every target, as files don't depend on it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from rowrelay.streaming.folders import file_system, names_in, put_text

#: Files of so many micro-batches stay; only the last can be run again.
KEPT = 10


class Counters:
    """The totals of one job in the folder ``place``; one driver writes them."""

    def __init__(self, spark: SparkSession, place: str):
        self.spark, self.place = spark, place
        self._known: tuple[int, dict[str, int]] | None = None

    def _batches(self) -> list[int]:
        return sorted(int(n) for n in names_in(self.spark, self.place) if n.isdigit())

    def _read(self, batch: int) -> dict[str, int]:
        return json.loads(self.spark.read.text(f"{self.place}/{batch}", wholetext=True).first().value)

    def before(self, batch: int) -> dict[str, int]:
        """The totals of all micro-batches before one."""
        if self._known and self._known[0] < batch:
            return self._known[1]
        earlier = [b for b in self._batches() if b < batch]
        return self._read(earlier[-1]) if earlier else {}

    def add(self, batch: int, counts: Mapping[str, int]) -> None:
        """Count a micro-batch. The file appears under its name only when it is whole."""
        old = self.before(batch)
        totals = {n: old.get(n, 0) + counts.get(n, 0) for n in [*old, *(c for c in counts if c not in old)]}
        put_text(self.spark, self.place, str(batch), json.dumps(totals))
        for old_batch in [b for b in self._batches() if b <= batch - KEPT]:
            system, there = file_system(self.spark, f"{self.place}/{old_batch}")
            system.delete(there, False)
        self._known = (batch, totals)

    def totals(self) -> dict[str, int]:
        """The totals up to the last micro-batch that was delivered."""
        batches = self._batches()
        return self._read(batches[-1]) if batches else {}
