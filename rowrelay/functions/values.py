"""Column values as they appear in a change record.

Every function maps a column to a column with built-in expressions, and null
stays null.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NTZ_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def decimal_to_double(c: Column) -> Column:
    """Decimals are written as doubles; digits beyond 2^53 units are lost."""
    return c.cast("double")


def unsigned_to_long(c: Column) -> Column:
    """An unsigned 64-bit value (DECIMAL(20,0)) as the signed value with the same bits."""
    wide = c.cast("decimal(21,0)")
    wrap, half = F.lit(Decimal(2**64)), F.lit(Decimal(2**63))
    return F.when(wide >= half, wide - wrap).otherwise(wide).cast("bigint")


def wrap_to_int(c: Column) -> Column:
    """The low 32 bits of an integer of up to 38 digits, as a signed INT.

    A plain cast raises on overflow in ANSI mode. Ids that fit a BIGINT take the
    shift path and never touch decimal arithmetic.
    """
    small = F.shiftright(F.shiftleft(c.cast("bigint"), 32), 32)
    limit, half, full = F.lit(Decimal(10**18)), F.lit(Decimal(2**31)), F.lit(Decimal(2**32))
    large = F.pmod(F.pmod(c.cast("decimal(38,0)"), full) + half, full) - half
    return F.when((c < limit) & (c > -limit), small).otherwise(large.cast("bigint")).cast("int")


def date_to_string(c: Column, data_type: T.DataType) -> Column:
    """A date, or a day count since 1970-01-01, as ``yyyy-MM-dd``."""
    if isinstance(data_type, T.IntegerType):
        return F.date_from_unix_date(c).cast("string")
    return c.cast("string")


def time_to_string(c: Column, data_type: T.DataType) -> Column:
    """A day-time interval inside one day as ``HH:mm:ss`` with the digits needed.

    Spark's JDBC reader gives a TIME as a timestamp on 1970-01-01; its time of day counts.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.substring(c.cast("string"), 12, 15)
    if not isinstance(data_type, T.DayTimeIntervalType):
        return c.cast("string")
    inside = (c >= F.expr("INTERVAL '0' SECOND")) & (c < F.expr("INTERVAL '24' HOUR"))
    text = F.substring((F.expr(NTZ_EPOCH) + c).cast("string"), 12, 15)
    problem = F.concat(F.lit("time outside one day: "), c.cast("string"))
    return F.when(c.isNull() | inside, text).otherwise(F.raise_error(problem))


def datetime_to_string(c: Column, data_type: T.DataType) -> Column:
    """A date and time without zone as ``yyyy-MM-dd HH:mm:ss`` with the digits needed."""
    return c.cast("string")


def timestamp_to_string(c: Column, data_type: T.DataType, zone: str | None = None) -> Column:
    """An instant as the local date and time in ``zone`` (default: the session zone).

    TIMESTAMP_NTZ input is read as UTC. The value travels as its microsecond count,
    so no step but the shift to ``zone`` looks at a zone, and instants around a
    clock change keep texts of their own.
    """
    epoch = F.expr(NTZ_EPOCH)
    if isinstance(data_type, T.TimestampNTZType):
        instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, c))
    elif isinstance(data_type, T.TimestampType):
        instant = c
    else:
        return c.cast("string")
    local = F.from_utc_timestamp(instant, F.lit(zone) if zone else F.current_timezone())
    return F.timestamp_add("MICROSECOND", F.unix_micros(local), epoch).cast("string")
