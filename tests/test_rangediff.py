"""Checksums of key ranges: the same changes as a full comparison, from few rows."""

import pytest
from pyspark.sql import functions as F

from rowrelay import Position
from rowrelay.operators.capture import diff
from rowrelay.operators.rangediff import RANGES, diff_by_ranges, differing

MARK = Position(1, 1)


def changes(frame):
    return sorted(map(str, frame.select("op", "before", "after").collect()))


def both_ways(old, new, keys=("id",)):
    whole = diff(old, new, list(keys), "d", "t", mark=MARK)
    assert changes(diff_by_ranges(old, new, list(keys), "d", "t", mark=MARK)) == changes(whole)
    return whole.count()


def table(spark, n=20000):
    return spark.range(n).select(F.col("id") * 3 - 5000, F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("a"), F.lit(None).cast("double").alias("b")).toDF("id", "a", "b")


def test_only_ranges_that_differ_are_joined(spark):
    old = table(spark)
    near = F.col("id").between(10000, 10600)
    new = old.withColumn("a", F.when(near & (F.col("id") % 2 == 0), None).otherwise(F.col("a"))).where(F.col("id") != 10003)
    assert both_ways(old, new) > 50
    found = differing(old, new, ["id"])
    assert 0 < len(found.numbers) <= RANGES
    assert old.where(found.holds(["id"])).count() <= 260  # of 20,000; the stretch has 201
    plan = old.where(found.holds(["id"]))._jdf.queryExecution().optimizedPlan().toString()
    assert ">=" in plan and "INSET" in plan.upper() or " IN " in plan.upper()


def test_kinds_of_changes(spark):
    old = table(spark, 300)
    swapped = old.withColumn("b", F.col("a").cast("double")).withColumn("a", F.col("b").cast("string"))
    for new in (old, old.limit(0), swapped, old.where("id % 5 = 0"), old.unionByName(old.withColumn("id", F.col("id") + 10**7))):
        both_ways(old, new)
        both_ways(new, old)
    assert differing(old, old, ["id"]).numbers == ()
    assert both_ways(old.limit(0), old.limit(0)) == 0


@pytest.mark.parametrize("keys", [["name"], ["name", "id"], ["id"]])
def test_any_key(spark, keys):
    """Text keys, several columns, and whole numbers from end to end."""
    rows = [(-(2**63), "a", 1), (2**63 - 1, "b", 2), (0, "c", None), (5, "é", 4)]
    old = spark.createDataFrame(rows, "id long, name string, v int")
    new = spark.createDataFrame([*rows[:2], (0, "c", 3), (6, "f", 4)], old.schema)
    assert both_ways(old, new, keys) == 3


def test_null_moves_between_columns(spark):
    """A hash that leaves nulls out would not see it."""
    old = spark.createDataFrame([(1, "x", None)], "id long, a string, b string")
    assert both_ways(old, spark.createDataFrame([(1, None, "x")], old.schema)) == 1
