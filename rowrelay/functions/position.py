"""Places in the change log and how records compare with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True, order=True)
class Position:
    """A place in the change log: log file number, offset in the file, row of the event."""

    sequence: int
    pos: int
    row: int = 0

    @property
    def file(self) -> str:
        return f"binlog.{self.sequence:06d}"


#: The place before every log: of a log that is still empty, and of a snapshot taken by offsets.
BEFORE_ALL = Position(0, 0)


def log_sequence(file: Column) -> Column:
    """The number at the end of a log file name; names do not order as text.

    Null for a record without a log file, such as one read by a snapshot. It sorts
    before every place in the log.
    """
    return F.substring_index(file, ".", -1).try_cast("bigint")


def position_order(source: str = "source") -> list[Column]:
    """Sort columns that put records in log order."""
    field = f"{source}." if source else ""
    return [
        log_sequence(F.col(f"{field}file")),
        F.col(f"{field}pos"),
        F.col(f"{field}row"),
    ]


def is_after(mark: Position, source: str = "source") -> Column:
    """Later than ``mark``. A record that does not say where it comes from is kept."""
    sequence, pos, row = position_order(source)
    later = (sequence > mark.sequence) | (
        (sequence == mark.sequence) & ((pos > mark.pos) | ((pos == mark.pos) & (row > mark.row)))
    )
    return F.coalesce(later, F.lit(True))
