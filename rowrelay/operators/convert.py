"""Type-driven conversion of a table's rows into change-record values."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowrelay.functions import values as V

# SQL type assumed for a Spark type when the table's own types are not given.
IMPLIED_SQL_TYPES = {
    T.DateType: "DATE",
    T.DayTimeIntervalType: "TIME",
    T.TimestampNTZType: "DATETIME",
    T.TimestampType: "TIMESTAMP",
    T.DecimalType: "DECIMAL",
}


def sql_type_name(declared: str) -> str:
    """``Timestamp(3)`` and ``TIMESTAMP`` name the same type here."""
    return " ".join(re.sub(r"\(.*?\)", " ", declared).upper().split())


def convert_column(c: Column, data_type: T.DataType, sql_type: str | None, zone: str | None) -> Column:
    if sql_type == "DATE":
        return V.date_to_string(c, data_type)
    if sql_type == "TIME":
        return V.time_to_string(c, data_type)
    if sql_type == "DATETIME":
        return V.datetime_to_string(c, data_type)
    if sql_type == "TIMESTAMP":
        return V.timestamp_to_string(c, data_type, zone)
    if sql_type in ("DECIMAL", "DECIMAL UNSIGNED", "NUMERIC", "NUMERIC UNSIGNED"):
        return V.decimal_to_double(c)
    if sql_type == "BIGINT UNSIGNED":
        return V.unsigned_to_long(c)
    # Numbers that Spark's JDBC reader gives as another type.
    if sql_type == "YEAR" and isinstance(data_type, T.DateType):
        return F.year(c)
    if sql_type == "TINYINT" and isinstance(data_type, T.BooleanType):
        return c.cast("int")
    return c


def convert_row(
    df: DataFrame, sql_types: Mapping[str, str] | None = None, zone: str | None = None
) -> DataFrame:
    """Convert every column by its SQL type, in one projection.

    ``sql_types`` maps column names to declared SQL types, in any case; columns it
    leaves out use the type implied by the Spark type. Types without a rule pass
    through unchanged. A whole DECIMAL of 20 digits, as which an unsigned BIGINT is
    read, must be declared: as a DECIMAL it would lose digits.
    """
    declared = {name: sql_type_name(t) for name, t in (sql_types or {}).items()}
    unknown = set(declared) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    wide = [f.name for f in df.schema.fields if f.dataType == T.DecimalType(20, 0) and f.name not in declared]
    if wide:
        raise ValueError(f"declare the SQL type of {wide}: DECIMAL(20) or BIGINT UNSIGNED")
    return df.select(
        *[
            convert_column(
                F.col(f"`{f.name}`"),
                f.dataType,
                declared.get(f.name, IMPLIED_SQL_TYPES.get(type(f.dataType))),
                zone,
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )
