"""Change-record pipelines on Spark DataFrames and Structured Streaming."""

from rowrelay.functions.position import Position
from rowrelay.options import Options
from rowrelay.plans.delivery import deliveries, run_batch, table_snapshot
from rowrelay.plans.job import Table, run_job
from rowrelay.sources.logs import KafkaLog, MessageFiles
from rowrelay.streaming.job import job_totals, start_stream, totals

__all__ = [
    "KafkaLog",
    "MessageFiles",
    "Options",
    "Position",
    "Table",
    "deliveries",
    "job_totals",
    "run_batch",
    "run_job",
    "start_stream",
    "table_snapshot",
    "totals",
]
