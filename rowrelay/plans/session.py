"""Session settings for a job of a given size."""

from __future__ import annotations

TASK_BYTES = 256 * 1024 * 1024


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings that keep a task's share of the input near 256 MB.

    Only ordering, gathering, diff and replay shuffle. Adaptive execution merges
    partitions that turn out small and splits skewed ones. Map tasks times reduce tasks
    is the number of shuffle blocks, which a caller may want to limit for huge inputs.
    """
    wanted = max(2 * cores, -(-input_bytes // TASK_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.shuffle.partitions": str(wanted),
    }
