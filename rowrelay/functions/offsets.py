"""Places in a log of several partitions: an offset for each partition of each topic."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a Kafka reader takes for the first offset that is still there.
EARLIEST = -2


@dataclass(frozen=True)
class Offsets:
    """The offset of the next record of each (topic, partition).

    A partition that is not in it has had no record yet: all its records come after.
    Two vectors compare partition by partition, so neither may come before the other.
    """

    following: Mapping[tuple[str, int], int] = field(default_factory=dict)

    def reaches(self, other: Offsets) -> bool:
        """Whether every record before ``other`` is before this vector, too."""
        return all(self.following.get(p, 0) >= offset for p, offset in other.following.items())

    def joined(self, other: Offsets) -> Offsets:
        """The smallest vector that reaches both."""
        both = dict(self.following)
        for place, offset in other.following.items():
            both[place] = max(offset, both.get(place, offset))
        return Offsets(both)

    def starting(self, partitions: Mapping[str, int]) -> str:
        """The vector as a Kafka reader's ``startingOffsets``.

        The reader wants each partition named, so ``partitions`` tells how many a topic has.
        """
        missing = sorted({t for t, _ in self.following} - set(partitions))
        beyond = [f"{t}-{p}" for t, p in sorted(self.following) if p >= partitions.get(t, p + 1)]
        if missing or beyond:
            raise ValueError(f"offsets of unknown topics or partitions: {missing + beyond}")
        named = {t: {str(p): self.following.get((t, p), EARLIEST) for p in range(n)} for t, n in partitions.items()}
        return json.dumps(named, sort_keys=True)


def ends(records: DataFrame) -> DataFrame:
    """``topic``, ``partition`` and ``following`` of a bounded read: one row a partition, pre-added in each task."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("following"))


def end_of(records: DataFrame) -> Offsets:
    """The end of a bounded read; the driver gets a number for each partition of the topics."""
    return Offsets({(r.topic, r.partition): r.following for r in ends(records).collect()})


def is_from(mark: Offsets, topic: str = "topic", partition: str = "partition", offset: str = "offset") -> Column:
    """At or past the vector, a literal with an array of offsets for each topic."""
    if not mark.following:
        return F.lit(True)
    topics: dict[str, dict[int, int]] = {}
    for (name, number), following in mark.following.items():
        topics.setdefault(name, {})[number] = following
    pairs = []
    for name, known in sorted(topics.items()):
        pairs += [F.lit(name), F.array(*[F.lit(known.get(i)).cast("bigint") for i in range(max(known) + 1)])]
    following = F.get(F.try_element_at(F.create_map(*pairs), F.col(topic)), F.col(partition).cast("int"))
    return F.coalesce(F.col(offset) >= following, F.lit(True))
