"""The outgoing record of each target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_record(routed: DataFrame) -> DataFrame:
    """Key and value are both the whole record text; the partition is explicit."""
    return routed.select("topic", F.col("value").alias("key"), "value", "partition")


def message_record(routed: DataFrame) -> DataFrame:
    """What a message client gets; it may use the partition to keep order."""
    return routed.select("topic", "partition", "value")


def pulsar_record(routed: DataFrame) -> DataFrame:
    """Value and topic only: no key, no partition choice."""
    return routed.select("topic", "value")
