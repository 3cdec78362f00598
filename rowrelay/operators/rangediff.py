"""Changes between two versions of a table, found by checksums of key ranges.

Both versions are reduced to a checksum for each of a bounded number of key ranges;
ranges that differ are cut finer and summed again, and only the rows of the ranges that
differ in the end are joined. A checksum needs one pass and moves one row a range and
task, so two versions that differ in a few places are compared without moving the
tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowrelay.functions.position import Position
from rowrelay.operators.capture import diff

#: Ranges that are summed at once; the driver holds the numbers of those that differ.
RANGES = 1024
#: Passes that cut differing ranges finer.
LEVELS = 3
#: Conditions on the key itself that a scan gets to skip files.
_CONDITIONS = 32

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Ranges:
    """Key ranges of 2**shift places each, by number; ``first`` is the place where number 0 begins."""

    key: str | None
    first: int
    shift: int
    numbers: tuple[int, ...]

    def number(self, keys: Sequence[str]) -> Column:
        return F.shiftright(_place(self.key, keys) - F.lit(self.first).cast("bigint"), self.shift)

    def spans(self) -> list[tuple[int, int]]:
        """The first and last place of each stretch of ranges; the nearest are joined if there are many."""
        width, spans = 1 << self.shift, []
        for n in self.numbers:
            low = self.first + n * width
            if spans and spans[-1][1] == low - 1:
                spans[-1] = (spans[-1][0], low + width - 1)
            else:
                spans.append((low, low + width - 1))
        while len(spans) > _CONDITIONS:
            at = min(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1])
            spans[at - 1 : at + 1] = [(spans[at - 1][0], spans[at][1])]
        return spans

    def holds(self, keys: Sequence[str]) -> Column:
        """Whether a row lies in one of the ranges; a scan of a sorted table skips files by it."""
        if not self.numbers:
            return F.lit(False)
        inside = self.number(keys).isin(list(self.numbers))
        if self.key is not None:
            key, near = F.col(f"`{self.key}`"), F.lit(False)
            for low, high in self.spans():
                near = near | ((key >= low) & (key <= min(high, (1 << 63) - 1)))
            inside = near & inside
        return inside


def _place(key: str | None, keys: Sequence[str]) -> Column:
    """Where a row stands: its first key if that is a whole number, or else a hash of all."""
    if key is not None:
        return F.col(f"`{key}`").cast("bigint")
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), 1)


def _sums(rows: DataFrame, number: Column, columns: Sequence[str]) -> DataFrame:
    """A checksum for each range that has rows, whatever their order; nulls count by their column."""
    parts = [p for c in columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), *parts)) for seed in (1, 2)]
    return rows.groupBy(number.alias("number")).agg(F.struct(F.count(F.lit(1)), *hashes).alias("sum"))


def differing(old: DataFrame, new: DataFrame, keys: Sequence[str], levels: int = LEVELS) -> Ranges:
    """The key ranges in which the versions differ, after at most ``levels`` passes over what still differs."""
    whole = all(isinstance(t.schema[keys[0]].dataType, _WHOLE) for t in (old, new))
    key = keys[0] if whole else None
    place = _place(key, keys)
    ends = [t.agg(F.min(place), F.max(place)).first() for t in (old, new)]
    low, high = (f((e[i] for e in ends if e[i] is not None), default=None) for i, f in ((0, min), (1, max)))
    if low is None:
        return Ranges(key, 0, 0, ())
    if high - low >= 1 << 62:  # the places don't fit a long's difference, so the hash's do
        key, low, high = None, 0, (1 << 63) - 1
    found = Ranges(key, low, max(0, ((high - low) // RANGES).bit_length()), ())
    columns, inside = old.columns, F.lit(True)
    for _ in range(levels):
        one, two = (_sums(t.where(inside), found.number(keys), columns) for t in (old, new))
        other = one.join(two.withColumnRenamed("sum", "sum2"), "number", "full_outer").where(~F.col("sum").eqNullSafe(F.col("sum2")))
        numbers = tuple(sorted(r.number for r in other.select("number").collect()))
        found = Ranges(found.key, found.first, found.shift, numbers)
        finer = min(found.shift, (RANGES // len(numbers)).bit_length() - 1 if numbers else 0)
        if not finer:
            break
        inside = found.holds(keys)
        deeper = Ranges(found.key, found.first, found.shift - finer, ())
        last, found = found, deeper
    else:
        found = last
    return found


def diff_by_ranges(
    old: DataFrame, new: DataFrame, keys: Sequence[str], db: str, table: str, *, mark: Position, levels: int = LEVELS, **times: Column
) -> DataFrame:
    """The same records as :func:`~rowrelay.operators.capture.diff`, joining only ranges that differ.

    The ranges are found when this is called. Two versions of a range with the same
    checksum, 128 bits and the number of rows, are taken as equal.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("both versions need the same columns")
    inside = differing(old, new, keys, levels).holds(keys)
    return diff(old.where(inside), new.where(inside), keys, db, table, mark=mark, **times)
