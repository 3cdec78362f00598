"""Include-lists for databases and tables, and the schema-change switch.

The functions work on parsed records (columns ``db``, ``table`` and ``op``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def include_pattern(names: str) -> str | None:
    """A comma-separated list of regexes as one full-match, case-blind pattern.

    A comma inside a regex is written ``\\,``. An empty list means no filter.
    """
    parts = [p.strip().replace("\\,", ",") for p in re.split(r"(?<!\\),", names)]
    parts = [p for p in parts if p]
    return "(?i)^(?:" + "|".join(f"(?:{p})" for p in parts) + ")$" if parts else None


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def in_databases(names: str) -> Column:
    pattern = include_pattern(names)
    return F.lit(True) if pattern is None else F.coalesce(F.col("db"), F.lit("")).rlike(pattern)


def in_tables(names: str) -> Column:
    """Match ``db.table``; a record that names no table is left to the database list."""
    pattern = include_pattern(names)
    if pattern is None:
        return F.lit(True)
    return _empty(F.col("table")) | F.concat_ws(".", "db", "table").rlike(pattern)


def include(
    records: DataFrame, databases: str = "", tables: str = "", schema_changes: bool = True
) -> DataFrame:
    """Keep the captured databases and tables, and schema changes when asked to."""
    keep = in_databases(databases) & in_tables(tables)
    if not schema_changes:
        keep = keep & F.col("op").isNotNull()
    return records.where(keep)
