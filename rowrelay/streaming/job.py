"""The streaming form of a delivery job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowrelay import fixed
from rowrelay.operators.ordering import exclusive_order, gather, narrow, spread, write_ranges
from rowrelay.options import Options
from rowrelay.plans.delivery import deliveries, progress_columns
from rowrelay.sinks.targets import Target
from rowrelay.streaming.counters import Counters
from rowrelay.streaming.waves import deliver_waves

# Where the queries started here keep their counters, by query id.
_counters: dict[str, Counters] = {}


def checkpoint_location(spark: SparkSession, opts: Options) -> str:
    """One folder per job id. Spark keeps it when a query stops, so a job can resume.

    It is in the option ``checkpoint_dir`` or the session's ``spark.checkpoint.dir``.
    Without either the job is refused: a new folder each time would deliver all again.
    """
    root = opts.checkpoint_dir or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("a streaming job needs checkpoint_dir or spark.checkpoint.dir to resume from")
    return f"{root.rstrip('/')}/{opts.job_id}"


def start_stream(
    wire: DataFrame,
    opts: Options,
    target: Target,
    *,
    available_now: bool = False,
    trigger: str = fixed.TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Deliver a stream of record texts (column ``value``), named after the job.

    Records reach the target at least once. The query keeps no state and no
    watermark; its checkpoint holds source offsets only. Without an order each
    micro-batch is one stage from source to target. With an order every micro-batch
    is sorted by log position first; micro-batches run one after another, so the
    order holds across them. Files are written by position range. A live target needs
    one task for a topic partition and so a limit on the micro-batch, one that the
    source can apply (sources refuse others), or ``in_waves``: fragments of a topic
    partition are then staged in the checkpoint's folder and sent one after another.

    Every target is written batch by batch, and the batch's counters are kept after it
    (:func:`totals`). For files that also avoids Spark's file stream sink, which
    keeps a list of all its files, growing with the job's life, and hides files of other
    writers, such as a snapshot delivered to the same folder.
    """
    routed = deliveries(wire, opts)
    place = checkpoint_location(wire.sparkSession, opts)
    counters = Counters(wire.sparkSession, counters_location(place))
    parallelism = opts.sink_parallelism if (opts.sink_parallelism or 1) > 1 else None
    arrange = {"none": narrow if opts.narrow else spread, "gathered": gather, "partition": exclusive_order}[opts.order]
    in_ranges = opts.order == "partition" and not target.single_writer
    in_waves = opts.in_waves and target.single_writer
    if opts.order == "partition" and target.single_writer and not in_waves:
        if not opts.bounded_batches:
            raise ValueError("ordered delivery to a live target needs a max_batch_* limit or in_waves")

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if in_waves:
            counts = deliver_waves(batch, batch_id, f"{place}/waves", target.write, progress_columns(), parallelism)
            counters.add(batch_id, counts)
            return
        # Counted behind the exchange: a range exchange reads its input twice.
        seen = Observation()

        def write(arranged: DataFrame) -> None:
            target.write(arranged.observe(seen, *progress_columns()))

        if in_ranges:
            write_ranges(batch, write, parallelism)
        else:
            write(arrange(batch, parallelism))
        counters.add(batch_id, seen.get)

    pace = {"availableNow": True} if available_now else {"processingTime": trigger}
    query = (
        routed.writeStream.foreachBatch(deliver)
        .queryName(opts.job_id)
        .option("checkpointLocation", place)
        .trigger(**pace)
        .start()
    )
    _counters[str(query.id)] = counters
    return query


def counters_location(place: str) -> str:
    return f"{place}-counters"


def job_totals(spark: SparkSession, opts: Options) -> dict[str, int]:
    """The counters of a job over all its starts: records, each operation, schema changes, fallback.

    They hold each micro-batch once, also one that was run again after a failure; a
    micro-batch that broke off in delivery is not in them until it is delivered whole. A
    job that has delivered none has no counters.
    """
    return Counters(spark, counters_location(checkpoint_location(spark, opts))).totals()


def totals(query: StreamingQuery) -> dict[str, int]:
    """As :func:`job_totals`, of a query started here."""
    return _counters[str(query.id)].totals()
