"""Conversion of column values."""

import datetime as dt
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from rowrelay.operators.convert import convert_row, sql_type_name


def one(spark, expression, sql_type=None, zone=None):
    frame = spark.sql(f"SELECT {expression} AS v")
    return convert_row(frame, {"v": sql_type} if sql_type else None, zone).first().v


@pytest.mark.parametrize(
    "expression, sql_type, text",
    [
        ("DATE'2024-02-29'", None, "2024-02-29"),
        ("DATE'0099-01-02'", "date", "0099-01-02"),
        ("19782", "DATE", "2024-02-29"),
        ("-1", "Date", "1969-12-31"),
        ("'2024'", "date", "2024"),
        ("INTERVAL '0' SECOND", None, "00:00:00"),
        ("INTERVAL '0 23:59:59.999999' DAY TO SECOND", "time", "23:59:59.999999"),
        ("INTERVAL '01:02:03.5' HOUR TO SECOND", "TIME(3)", "01:02:03.5"),
        ("TIMESTAMP_NTZ'2024-01-02 03:04:05'", None, "2024-01-02 03:04:05"),
        ("TIMESTAMP_NTZ'2024-01-02 03:04:05.120'", "datetime", "2024-01-02 03:04:05.12"),
        ("TIMESTAMP_NTZ'2024-01-02 00:00:00'", "DATETIME(6)", "2024-01-02 00:00:00"),
        ("12", "datetime", "12"),
        ("true", "timestamp", "true"),
    ],
)
def test_texts(spark, expression, sql_type, text):
    assert one(spark, expression, sql_type) == text


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
@pytest.mark.parametrize(
    "zone, text",
    [
        ("UTC", "2023-09-08 15:24:59"),
        ("Asia/Shanghai", "2023-09-08 23:24:59"),
        ("America/New_York", "2023-09-08 11:24:59"),
        (None, "2023-09-08 15:24:59"),
    ],
)
def test_timestamp_zones(spark, kind, zone, text):
    assert one(spark, f"{kind}'2023-09-08 15:24:59'", "timestamp", zone) == text


def test_instants_around_a_clock_change_stay_apart(spark):
    """05:30 and 06:30 UTC are both 01:30 in New York on that day, before and after the change."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        texts = [one(spark, f"TIMESTAMP'2024-11-03 0{h}:30:00Z'", "timestamp", "UTC") for h in (5, 6)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert texts == ["2024-11-03 05:30:00", "2024-11-03 06:30:00"]


@pytest.mark.parametrize("interval", ["INTERVAL '24' HOUR", "INTERVAL '-1' SECOND", "INTERVAL '34 22:59:59' DAY TO SECOND"])
def test_time_outside_one_day_fails(spark, interval):
    with pytest.raises((PySparkException, Py4JJavaError), match="time outside one day"):
        one(spark, interval, "time")


def test_numbers(spark):
    assert one(spark, "CAST('12345678901.25' AS DECIMAL(14,2))") == 12345678901.25
    assert one(spark, "CAST('0.00' AS DECIMAL(14,2))", "decimal(14,2)") == 0.0
    assert one(spark, "CAST('7' AS DECIMAL(20,0))", "bigint unsigned") == 7
    assert one(spark, "CAST('18446744073709551615' AS DECIMAL(20,0))", "BIGINT(20) UNSIGNED") == -1
    assert one(spark, "CAST('9223372036854775808' AS DECIMAL(20,0))", "bigint unsigned") == -(2**63)
    assert one(spark, "CAST('9223372036854775807' AS DECIMAL(20,0))", "bigint unsigned") == 2**63 - 1


def test_types_of_a_database_read(spark):
    assert one(spark, "TIMESTAMP'1970-01-01 23:05:06'", "time") == "23:05:06"
    assert one(spark, "TIMESTAMP_NTZ'1970-01-01 01:02:03.25'", "TIME(2)") == "01:02:03.25"
    assert one(spark, "TIMESTAMP'2024-01-02 03:04:05'", "datetime") == "2024-01-02 03:04:05"
    assert one(spark, "DATE'2024-01-01'", "year(4)") == 2024
    assert one(spark, "true", "tinyint(1)") == 1


def test_other_types_pass_through(spark):
    assert one(spark, "2024", "year") == 2024
    assert one(spark, "'x'", "varchar(3)") == "x"
    assert one(spark, "X'00ff'") == b"\x00\xff"


def test_nulls(spark):
    kinds = {
        "date": "DATE",
        "time": "INTERVAL DAY TO SECOND",
        "datetime": "TIMESTAMP_NTZ",
        "timestamp": "TIMESTAMP",
        "decimal": "DECIMAL(14,2)",
        "bigint unsigned": "DECIMAL(20,0)",
    }
    for sql_type, kind in kinds.items():
        assert one(spark, f"CAST(NULL AS {kind})", sql_type) is None


def test_type_names():
    assert sql_type_name("timestamp(3)") == "TIMESTAMP"
    assert sql_type_name(" bigint(20)  unsigned ") == "BIGINT UNSIGNED"


def test_unknown_columns_are_rejected(spark):
    with pytest.raises(ValueError):
        convert_row(spark.range(1), {"nothing": "date"})


def test_python_values_agree(spark):
    rows = [
        (dt.date(2000, 1, d + 1), dt.timedelta(seconds=997 * d, microseconds=d), Decimal(d) / 4) for d in range(28)
    ]
    frame = spark.createDataFrame(rows, "d date, t interval day to second, m decimal(14,2)")
    for (day, clock, money), out in zip(rows, convert_row(frame).collect()):
        assert out.d == day.isoformat()
        assert out.t == (dt.datetime(1970, 1, 1) + clock).isoformat()[11:].rstrip("0" if clock.microseconds else "")
        assert out.m == float(money)


def test_unsigned_ids_must_be_declared(spark):
    frame = spark.sql("SELECT CAST('9007199254740993' AS DECIMAL(20,0)) AS id")
    with pytest.raises(ValueError, match="id"):
        convert_row(frame)
    assert convert_row(frame, {"id": "BIGINT UNSIGNED"}).first().id == 9007199254740993


def test_dates_behind_the_year_9999_have_a_sign(spark):
    """As ISO dates are written: years of more than four digits begin with a plus."""
    days = spark.createDataFrame([(2932896,), (2932897,)], "day int")
    texts = [r.day for r in convert_row(days, {"day": "date"}).collect()]
    assert texts == ["9999-12-31", "+10000-01-01"]
