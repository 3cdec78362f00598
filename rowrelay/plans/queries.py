"""Registered queries: each operator over the whole of its tables.

A query takes the session and the folder of the tables and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowrelay import fixed
from rowrelay.functions import values as V
from rowrelay.functions.position import Position, is_after, position_order
from rowrelay.functions.record import decode, encode, parse
from rowrelay.operators import capture, filters, rangediff, routing
from rowrelay.operators.convert import convert_row
from rowrelay.operators.replay import apply_changes, last_changes, replay, replay_records, row_key
from rowrelay.operators.timeline import column_lists, decode_by_timeline
from rowrelay.options import Options
from rowrelay.plans import orders as order_rules
from rowrelay.plans.chunks import Chunk, ChunkedTable, capture_in_chunks, snapshot_chunks
from rowrelay.plans.delivery import deliveries, routed_records, run_batch, table_snapshot
from rowrelay.plans.job import Table, run_job
from rowrelay.plans.tablelog import (
    EPOCH_MS,
    IMAGE,
    change_log,
    drawn_orders,
    event_log,
    moving_log,
    order_versions,
    truncates,
    versioned_log,
    wire_log,
)
from rowrelay.sinks import records as outgoing
from rowrelay.sinks.buckets import BucketedState
from rowrelay.sinks.targets import Target, compressed, files
from rowrelay.sources.changelog import read_delivered, read_files, stream_text
from rowrelay.sources.logindex import LogIndex
from rowrelay.sources.logs import MessageFiles
from rowrelay.sources.parsedlog import ParsedLog
from rowrelay.sources.tables import read_parquet
from rowrelay.streaming.folders import new_folder, staged
from rowrelay.streaming.job import job_totals, start_stream

Query = Callable[[SparkSession, str], DataFrame]

FOUR = Options(partitions=4)
MARK = Position(1, 30000)
#: Logs and deliveries are written as compressed texts.
PACKED = "lz4"
START_MS = EPOCH_MS + 30000 * 1000

_registered: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registered[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registered)


def _flat(changes: DataFrame) -> DataFrame:
    """The fields of a change frame that say which change it is."""
    return changes.select(
        F.col("source.file").alias("file"),
        F.col("source.pos").alias("pos"),
        F.col("source.db").alias("db"),
        F.col("source.table").alias("tbl"),
        "op",
        F.col("before.id").alias("before_id"),
        F.col("after.id").alias("after_id"),
        F.col("after.status").alias("after_status"),
        F.col("after.price").alias("after_price"),
    )


def _typed_wire(spark: SparkSession, folder: str) -> DataFrame:
    """The change log after a trip through its text form."""
    return decode(wire_log(spark, folder), IMAGE)


# --- the whole job -----------------------------------------------------------


@query
def routed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tables to changes to texts to topics and partitions, counted."""
    return routing.fanout_counts(deliveries(wire_log(spark, folder), FOUR))


# --- capture -----------------------------------------------------------------


@query
def snapshot_capture(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot of the order table, converted, encoded and read back."""
    rows = read_parquet(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
        F.col("o_orderdate").alias("created_time"),
        F.col("o_orderpriority").alias("priority"),
    )
    records = capture.snapshot(
        convert_row(rows), "test", "tb_order", mark=MARK, ts_ms=F.lit(EPOCH_MS), processed_ms=F.lit(EPOCH_MS)
    )
    image = (
        "id: bigint, user_id: bigint, status: string, price: double, created_time: string, priority: string"
    )
    return decode(encode(records), image).select(
        "after.*",
        F.col("before").isNull().alias("no_before"),
        F.col("source.db").alias("db"),
        F.col("source.table").alias("tbl"),
        F.col("source.snapshot").alias("snapshot"),
        F.col("source.pos").alias("pos"),
        "op",
        "ts_ms",
    )


@query
def snapshot_unsigned(spark: SparkSession, folder: str) -> DataFrame:
    """Unsigned keys that no double can hold, declared, through the text form."""
    key = F.col("o_orderkey").cast("decimal(18,0)") * F.lit(2**53 + 1).cast("decimal(18,0)")
    rows = read_parquet(spark, folder, "orders").select(
        "o_orderkey", (key % F.lit(Decimal(2**64))).cast("decimal(20,0)").alias("id")
    )
    texts = table_snapshot(rows, FOUR, "test", "tb_wide", MARK, {"id": "bigint(20) unsigned"})
    return decode(texts, "o_orderkey: bigint, id: bigint").select("after.*")


@query
def latest_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(capture.latest(_typed_wire(spark, folder), MARK))


@query
def timestamp_start(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(capture.from_timestamp(_typed_wire(spark, folder), START_MS))


@query
def log_end(spark: SparkSession, folder: str) -> DataFrame:
    """The mark a later start would use."""
    return capture.last_position(_typed_wire(spark, folder)).withColumnRenamed("row", "row_no")


def _state_at_mark(spark: SparkSession, folder: str) -> DataFrame:
    """The order rows as they were at the mark, as snapshot records."""
    changes = change_log(spark, folder)
    past = changes.where(~is_after(MARK) & (F.col("source.db") == "test"))
    rows = replay(past).select("after.*")
    return capture.snapshot(
        rows, "test", "tb_order", mark=MARK, ts_ms=F.lit(START_MS), processed_ms=F.lit(START_MS)
    )


def _start(spark: SparkSession, folder: str, mode: int) -> DataFrame:
    return capture.start(
        mode,
        change_log(spark, folder),
        mark=MARK,
        snapshot_changes=_state_at_mark(spark, folder),
        epoch_ms=START_MS,
    )


@query
def start_mode_initial(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_start(spark, folder, fixed.START_INITIAL))


@query
def start_mode_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_start(spark, folder, fixed.START_LATEST))


@query
def start_mode_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_start(spark, folder, fixed.START_TIMESTAMP))


@query
def snapshot_then_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Handoff through the text form, replayed: the final rows of every table."""
    both = capture.handoff(_state_at_mark(spark, folder), change_log(spark, folder), MARK)
    state = replay(decode(encode(both), IMAGE))
    return state.select("db", F.col("table").alias("tbl"), "after.*")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return parse(wire_log(spark, folder), position=True)


def _named(records: DataFrame) -> DataFrame:
    return records.select("file", "pos", "db", F.col("table").alias("tbl"), "op")


@query
def filter_databases(spark: SparkSession, folder: str) -> DataFrame:
    return _named(filters.include(_records(spark, folder), databases="crm,te"))


@query
def filter_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Both a plain name and a pattern; schema changes without a table stay."""
    return _named(filters.include(_records(spark, folder), tables=r"test\.tb_ord, CRM\.tb_.*"))


@query
def schema_change_records(spark: SparkSession, folder: str) -> DataFrame:
    """Kept with the switch on, next to the captured database's rows."""
    return _named(filters.include(_records(spark, folder), databases="test"))


@query
def schema_changes_off(spark: SparkSession, folder: str) -> DataFrame:
    return _named(filters.include(_records(spark, folder), databases="test", schema_changes=False))


@query
def schema_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Images of a table whose columns change four times, each read by its own columns."""
    wire = versioned_log(spark, folder)
    found = decode_by_timeline(wire, column_lists(wire)).where(F.col("op").isNotNull())
    listed = lambda field: F.array_join(F.transform("after", lambda c: c[field]), ",", "~")
    return found.select("pos", "op", listed("name").alias("names"), listed("type").alias("types"), listed("value").alias("image"), F.size("extra").alias("n_extra"))


def _order_diff(spark: SparkSession, folder: str) -> DataFrame:
    old, new = order_versions(spark, folder)
    return capture.diff(
        old, new, ["id"], "test", "tb_order", mark=MARK, ts_ms=F.lit(START_MS), processed_ms=F.lit(START_MS)
    )


@query
def table_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _order_diff(spark, folder).select(
        "op",
        *[F.col(f"before.{c}").alias(f"before_{c}") for c in ("id", "user_id", "status")],
        *[F.col(f"after.{c}").alias(f"after_{c}") for c in ("id", "user_id", "status")],
        *[V.decimal_to_double(F.col(f"{i}.price")).alias(f"{i}_price") for i in ("before", "after")],
    )


def _near_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The order table and a version of it that differs in a hundredth of the keys alone, and by a few new ones."""
    old, new = order_versions(spark, folder)
    near = F.call_function("div", F.col("id"), F.lit(100).cast("bigint")) % 100 == 40
    return old, old.where(~near).unionByName(new.where(near))


@query
def diff_by_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The changes between two versions, from the key ranges whose checksums differ."""
    old, new = _near_versions(spark, folder)
    found = rangediff.diff_by_ranges(old, new, ["id"], "test", "tb_order", mark=MARK, ts_ms=F.lit(START_MS), processed_ms=F.lit(START_MS))
    return found.select(
        "op",
        *[F.col(f"before.{c}").alias(f"before_{c}") for c in ("id", "user_id", "status")],
        *[F.col(f"after.{c}").alias(f"after_{c}") for c in ("id", "user_id", "status")],
        *[V.decimal_to_double(F.col(f"{i}.price")).alias(f"{i}_price") for i in ("before", "after")],
    )


@query
def diff_applied(spark: SparkSession, folder: str) -> DataFrame:
    """The old version with the difference applied is the new version."""
    old, _ = order_versions(spark, folder)
    rows = apply_changes(old, _order_diff(spark, folder), ["id"], "test", "tb_order")
    return rows.withColumn("price", V.decimal_to_double(F.col("price")))


@query
def apply_mixed_log(spark: SparkSession, folder: str) -> DataFrame:
    """As ``diff_applied``, from a log in which another table loses rows of the same keys."""
    old, _ = order_versions(spark, folder)
    gone = capture.diff(
        old, old.where(F.lit(False)), ["id"], "test", "tb_archive", mark=MARK, ts_ms=F.lit(START_MS), processed_ms=F.lit(START_MS)
    )
    rows = apply_changes(old, _order_diff(spark, folder).unionByName(gone), ["id"], "test", "tb_order")
    return rows.withColumn("price", V.decimal_to_double(F.col("price")))


@query
def replay_truncate(spark: SparkSession, folder: str) -> DataFrame:
    """The current rows of both tables after several truncates of one of them."""
    log = wire_log(spark, folder).unionByName(truncates(spark, folder))
    state = replay(decode(log, IMAGE), truncates=True)
    return state.select("db", F.col("table").alias("tbl"), "after.*")


# --- encoding ----------------------------------------------------------------


@query
def envelope_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    typed = _typed_wire(spark, folder)
    return typed.select(
        *[F.col(f"before.{c}").alias(f"before_{c}") for c in ("id", "status", "price")],
        *[F.col(f"after.{c}").alias(f"after_{c}") for c in ("id", "status", "price")],
        F.col("source.connector").alias("connector"),
        F.col("source.snapshot").alias("snapshot"),
        F.col("source.db").alias("db"),
        F.col("source.table").alias("tbl"),
        F.col("source.file").alias("file"),
        F.col("source.pos").alias("pos"),
        F.col("source.row").alias("row_no"),
        F.col("source.ts_ms").alias("source_ts_ms"),
        F.col("source.gtid").alias("gtid"),
        "op",
        "ts_ms",
        "transaction",
    )


@query
def envelope_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The names written at the top of every record, nulls included."""
    names = F.array_join(F.json_object_keys("value"), ",")
    return wire_log(spark, folder).groupBy(names.alias("fields")).agg(F.count(F.lit(1)).alias("records"))


@query
def decimal_to_double(spark: SparkSession, folder: str) -> DataFrame:
    money = F.col("l_extendedprice").cast("decimal(14,2)")
    return read_parquet(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", V.decimal_to_double(money).alias("price")
    )


@query
def unsigned_to_long(spark: SparkSession, folder: str) -> DataFrame:
    """Keys spread over the unsigned 64-bit range."""
    factor = F.lit(1152921504606846993).cast("decimal(20,0)")
    spread = (F.col("o_orderkey").cast("decimal(18,0)") * factor) % F.lit(Decimal(2**64))
    return read_parquet(spark, folder, "orders").select(
        "o_orderkey", V.unsigned_to_long(spread.cast("decimal(20,0)")).alias("signed_value")
    )


@query
def date_to_string(spark: SparkSession, folder: str) -> DataFrame:
    """From dates and from day counts."""
    rows = read_parquet(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"), "l_partkey"
    )
    rows = rows.withColumn("day_count", (F.col("l_partkey") * 7 - 500).cast("int"))
    texts = convert_row(rows, {"day": "date", "day_count": "Date"})
    return texts.select("l_orderkey", "l_linenumber", "l_partkey", "day", "day_count")


@query
def time_to_string(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_parquet(spark, folder, "events")
    rows = rows.select("event_id", (F.col("ts") - F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("t"))
    return convert_row(rows, {"t": "time(6)"}).select("event_id", F.col("t").alias("time_text"))


@query
def datetime_to_string(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_parquet(spark, folder, "events").select("event_id", F.col("ts").alias("datetime_text"))
    return convert_row(rows, {"datetime_text": "DATETIME"})


@query
def timestamp_to_local(spark: SparkSession, folder: str) -> DataFrame:
    """Two zones, one with clock changes, from both timestamp types."""
    events = read_parquet(spark, folder, "events").select(
        F.lit("events").alias("origin"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("from_utc"),
        F.to_timestamp_ltz(F.concat(F.col("ts").cast("string"), F.lit("Z"))).alias("from_instant"),
    )
    orders = read_parquet(spark, folder, "orders").select(
        F.lit("orders").alias("origin"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("from_utc"),
        F.to_timestamp_ltz(F.concat(F.col("o_orderdate").cast("string"), F.lit("Z"))).alias("from_instant"),
    )
    declared = {"from_utc": "timestamp", "from_instant": "TIMESTAMP(6)"}
    east = convert_row(events, declared, zone="Asia/Shanghai")
    return east.unionByName(convert_row(orders, declared, zone="America/New_York"))


@query
def convert_row_types(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule at once, chosen by declared and by implied type."""
    shipped = F.col("l_shipdate")
    rows = read_parquet(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(14,2)").alias("money"),
        shipped.cast("date").alias("day"),
        shipped.alias("moment"),
        F.timestamp_add("SECOND", F.col("l_partkey"), shipped).alias("instant"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber"), F.col("l_quantity")).alias("clock"),
        (F.col("l_orderkey").cast("decimal(20,0)") + F.lit(Decimal(2**63)))
        .cast("decimal(20,0)")
        .alias("unsigned"),
        (F.lit(1990) + F.col("l_linenumber")).alias("year_no"),
        F.col("l_returnflag").alias("flag"),
    )
    declared = {
        "instant": "TimeStamp",
        "clock": "time",
        "unsigned": "bigint(20) unsigned",
        "year_no": "YEAR",
        "flag": "varchar(1)",
    }
    return convert_row(rows, declared, zone="Asia/Shanghai")


@query
def convert_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Null stays null for every rule; a value of another class becomes its text."""
    there = F.col("o_orderstatus") == "F"
    moment = F.col("o_orderdate")
    rows = read_parquet(spark, folder, "orders").select(
        "o_orderkey",
        F.when(there, F.col("o_totalprice").cast("decimal(14,2)")).alias("money"),
        F.when(there, moment.cast("date")).alias("day"),
        F.when(there, moment - moment).alias("clock"),
        F.when(there, moment).alias("moment"),
        F.when(there, moment).alias("instant"),
        F.when(there, F.col("o_orderkey").cast("decimal(20,0)")).alias("unsigned"),
        F.when(there, F.col("o_orderkey")).alias("day_other"),
        F.when(there, F.col("o_orderpriority")).alias("clock_other"),
        F.when(there, F.col("o_custkey")).alias("moment_other"),
        F.when(there, F.col("o_custkey") > 500).alias("instant_other"),
    )
    declared = {
        "clock": "time",
        "instant": "timestamp",
        "unsigned": "bigint unsigned",
        "day_other": "date",
        "clock_other": "time",
        "moment_other": "datetime",
        "instant_other": "timestamp",
    }
    return convert_row(rows, declared, zone="UTC")


# --- extraction --------------------------------------------------------------


@query
def parse_source(spark: SparkSession, folder: str) -> DataFrame:
    return _named(_records(spark, folder))


@query
def extract_row_id(spark: SparkSession, folder: str) -> DataFrame:
    return _records(spark, folder).select("file", "pos", F.col("row_id").cast("bigint").alias("row_id"))


@query
def extract_wide_id(spark: SparkSession, folder: str) -> DataFrame:
    """Ids written as strings and as 20-digit numbers."""
    key = F.col("o_orderkey").cast("string")
    wide = F.concat(F.lit("123456789012345"), F.lpad(key, 9, "0"))
    number = F.concat(F.lit('{"after":{"id":'), wide, F.lit('},"source":{"db":"a","table":"b"}}'))
    text = F.concat(F.lit('{"after":{"id":"'), key, F.lit('"},"source":{"db":"a","table":"b"}}'))
    orders = read_parquet(spark, folder, "orders")
    records = orders.select("o_orderkey", F.explode(F.array(number, text)).alias("value"))
    return parse(records, keep=["o_orderkey"]).select(
        "o_orderkey", F.col("row_id").cast("string").alias("row_id"), V.wrap_to_int(F.col("row_id")).alias("id32")
    )


# --- routing -----------------------------------------------------------------


@query
def route_topic(spark: SparkSession, folder: str) -> DataFrame:
    return deliveries(wire_log(spark, folder), FOUR, position=True).select("file", "pos", "topic")


@query
def route_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Every mix of present, empty and null names, each order carrying one mix."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    db = F.when(status == "F", F.lit("")).when(status == "O", F.lit("test"))
    table = F.when(priority < "3", F.lit("tb_order")).when(priority < "5", F.lit(""))
    source = F.struct(db.alias("db"), table.alias("table"))
    value = F.to_json(F.struct(source.alias("source")), {"ignoreNullFields": "false"})
    orders = read_parquet(spark, folder, "orders").select("o_orderkey", value.alias("value"))
    records = routing.with_topic(parse(orders, keep=["o_orderkey"]))
    return records.select("o_orderkey", "db", F.col("table").alias("tbl"), "topic")


@query
def fanout_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events of every type fan out to their own topics."""
    return routing.fanout_counts(deliveries(event_log(spark, folder), Options(partitions=8)))


@query
def partition_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return deliveries(wire_log(spark, folder), FOUR, position=True).select("file", "pos", "topic", "partition")


@query
def partition_by_topic_count(spark: SparkSession, folder: str) -> DataFrame:
    """A partition count per topic; topics not listed use the default."""
    opts = Options(partitions={"mysqlbinlog_test_tb_order": 7}, default_partitions=3)
    return deliveries(wire_log(spark, folder), opts, position=True).select("file", "pos", "topic", "partition")


@query
def partition_by_many_topics(spark: SparkSession, folder: str) -> DataFrame:
    """A long map of partition counts, with the log's topics among its last."""
    counts = {f"{fixed.TOPIC_PREFIX}other_{i}": 2 for i in range(100_000)}
    counts |= {"mysqlbinlog_test_tb_order": 7, "mysqlbinlog_crm_tb_customer": 5}
    opts = Options(partitions=counts, default_partitions=3)
    return deliveries(wire_log(spark, folder), opts, position=True).select("file", "pos", "topic", "partition")


@query
def partition_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """Records without a row image go to slot 0."""
    routed = deliveries(wire_log(spark, folder), FOUR, position=True)
    return routed.where(F.col("row_id").isNull()).select("file", "pos", "op", "topic", "partition")


@query
def partition_deletes_by_before_id(spark: SparkSession, folder: str) -> DataFrame:
    """The option that keeps a delete in its row's partition."""
    routed = deliveries(wire_log(spark, folder), FOUR.with_(delete_partition="before_id"), position=True)
    return routed.select("file", "pos", "op", "topic", "partition")


@query
def id_wrap(spark: SparkSession, folder: str) -> DataFrame:
    """Ids on both sides of the 32-bit and 64-bit limits."""
    key = F.col("o_orderkey").cast("decimal(18,0)")
    wide = (key * F.lit(12345678901234567).cast("decimal(18,0)")).cast("decimal(38,0)")
    narrow = (key * F.lit(715827883).cast("decimal(18,0)") - F.lit(5 * 10**12)).cast("decimal(38,0)")
    rows = read_parquet(spark, folder, "orders").select(
        "o_orderkey", F.explode(F.array(wide, narrow, -wide)).alias("row_id")
    )
    return rows.select(
        "o_orderkey",
        F.col("row_id").cast("string").alias("row_id"),
        V.wrap_to_int(F.col("row_id")).alias("id32"),
        routing.partition(F.col("row_id"), F.lit(7)).alias("partition"),
    )


@query
def partition_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each record in the files that ordered delivery wrote."""
    out = new_folder(spark, "ordered")
    run_batch(wire_log(spark, folder), FOUR.with_(order="partition"), files(out, by_partition=True, compression=PACKED))
    delivered = parse(read_delivered(spark, out), keep=["topic", "partition", "sequence"], position=True)
    return delivered.select("topic", "partition", "file", "pos", "sequence")


def _into_table(path: str) -> Target:
    """A live target whose messages are rows, with the wave and the place in it that each was sent in."""
    columns = ["topic", "partition", "value", "wave", F.monotonically_increasing_id().alias("place")]
    return Target("parquet", lambda routed: routed.select(*columns), {"path": path})


@query
def waves_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each record in what a live target got, with topic partitions sent by several tasks."""
    source, out = _stage(wire_log(spark, folder), "waves-log"), new_folder(spark, "waves")
    opts = FOUR.with_(job_id="waves", order="partition", in_waves=True, sink_parallelism=12, checkpoint_dir=new_folder(spark, "job"))
    start_stream(stream_text(spark, source, opts), opts, _into_table(out), available_now=True).awaitTermination()
    got, own = spark.read.parquet(out), ["topic", "partition", "wave"]
    # Numbered inside a wave, after the records of the waves before; the texts stay behind.
    earlier = Window.partitionBy("topic", "partition").orderBy("wave").rowsBetween(Window.unboundedPreceding, -1)
    before = got.groupBy(*own).count().select(*own, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    rows = parse(got, keep=[*own, "place"], position=True).select(*own, "file", "pos", "place")
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy(*own).orderBy("place")))
    return rows.join(before, own).select("topic", "partition", "file", "pos", (F.col("before") + F.col("at") - 1).alias("sequence"))


# --- outgoing records --------------------------------------------------------


@query
def kafka_record(spark: SparkSession, folder: str) -> DataFrame:
    """Key and value read back: both hold the whole record."""
    out = outgoing.kafka_record(deliveries(wire_log(spark, folder), FOUR))
    record = parse(out, keep=["topic", "partition", "key"], position=True)
    return record.select(
        "topic",
        "partition",
        "file",
        "pos",
        F.col("row_id").cast("bigint").alias("row_id"),
        "op",
        (F.col("key") == F.col("value")).alias("key_is_value"),
    )


@query
def pulsar_record(spark: SparkSession, folder: str) -> DataFrame:
    out = outgoing.pulsar_record(deliveries(wire_log(spark, folder), FOUR))
    record = parse(out, keep=["topic"], position=True)
    return record.select("topic", "file", "pos", F.col("row_id").cast("bigint").alias("row_id"), "op")


# --- streams -----------------------------------------------------------------


def _append(wire: DataFrame, folder: str) -> None:
    """More record texts in a folder."""
    wire.write.mode("append").options(**compressed(PACKED)).text(folder)


def _stage(wire: DataFrame, name: str) -> str:
    """Record texts written to the shared folder, for a stream to read."""
    folder = new_folder(wire.sparkSession, name)
    _append(wire, folder)
    return folder


def _drain(spark: SparkSession, source: str, opts: Options, out: str) -> None:
    target = files(out, by_partition=True, compression=PACKED)
    start_stream(stream_text(spark, source, opts), opts, target, available_now=True).awaitTermination()


def _delivered(spark: SparkSession, out: str) -> DataFrame:
    return parse(spark.read.text(out), keep=["topic", "partition"]).select(
        F.col("row_id").cast("bigint").alias("row_id"), "topic", "partition"
    )


@query
def stream_route(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of texts, routed into one folder per topic partition."""
    source, out = _stage(event_log(spark, folder), "events"), new_folder(spark, "routed")
    opts = Options(job_id="stream_route", partitions=4, checkpoint_dir=new_folder(spark, "job"))
    _drain(spark, source, opts, out)
    return _delivered(spark, out)


@query
def stream_resume(spark: SparkSession, folder: str) -> DataFrame:
    """A job stopped and started again twice, with new files before the last start.

    The restart without new files adds nothing, and the last one adds only the
    new files' records.
    """
    source, out = _stage(event_log(spark, folder), "events"), new_folder(spark, "resumed")
    opts = Options(job_id="stream_resume", partitions=4, checkpoint_dir=new_folder(spark, "job"))
    _drain(spark, source, opts, out)
    _drain(spark, source, opts, out)
    _append(wire_log(spark, folder), source)
    _drain(spark, source, opts, out)
    return _delivered(spark, out)


def _job(spark: SparkSession, folder: str, mode: int) -> DataFrame:
    """A job started on the log up to the mark, stopped, and started again on the whole log.

    Delivered to files and read back.
    """
    wire = parse(wire_log(spark, folder), position=True)
    later = is_after(MARK, "")
    source, out = _stage(wire.where(~later).select("value"), "log"), new_folder(spark, "delivered")
    opts = Options(
        job_id=f"job_{mode}",
        partitions=4,
        start_mode=mode,
        start_timestamp=START_MS if mode == fixed.START_TIMESTAMP else 0,
        checkpoint_dir=new_folder(spark, "job"),
    )
    target = files(out, by_partition=True, compression=PACKED)
    rows = replay(change_log(spark, folder).where(~is_after(MARK) & (F.col("source.db") == "test"))).select("after.*")
    tables = {"test.tb_order": Table(rows)}
    run_job(spark, source, opts, target, tables, available_now=True).awaitTermination()
    _append(wire.where(later).select("value"), source)
    run_job(spark, source, opts, target, tables, available_now=True).awaitTermination()
    found = parse(read_files(spark, out), keep=["topic", "partition"], before=True)
    ids = [F.col(c).cast("bigint").alias(c) for c in ("row_id", "before_id")]
    return found.select("topic", "partition", "op", *ids)


@query
def job_initial(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot and later changes, each once, over two starts."""
    return _job(spark, folder, fixed.START_INITIAL)


@query
def job_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Only what came after the first start."""
    return _job(spark, folder, fixed.START_LATEST)


@query
def job_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, folder, fixed.START_TIMESTAMP)


@query
def job_latest_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """What came after the ends of a log's three partitions, each at another place.

    The log is kept as messages in files, and the second start finds a file with the whole log.
    """
    records = parse(wire_log(spark, folder), position=True)
    sequence, pos, _ = position_order("")
    messages = records.select(
        F.lit("log").alias("topic"),
        (pos % 3).cast("int").alias("partition"),
        (sequence * (1 << 40) + pos).alias("offset"),
        F.col("value").cast("binary").alias("value"),
    )
    first = F.col("offset") <= (1 << 40) + 10000 * (F.col("partition") + 1)
    source, out = new_folder(spark, "messages"), new_folder(spark, "delivered")
    messages.where(first).write.parquet(source)
    opts = Options(job_id="job_offsets", partitions=4, start_mode=fixed.START_LATEST, checkpoint_dir=new_folder(spark, "job"))
    log, target = MessageFiles(source), files(out, by_partition=True, compression=PACKED)
    run_job(spark, log, opts, target, available_now=True).awaitTermination()
    messages.write.mode("append").parquet(source)
    run_job(spark, log, opts, target, available_now=True).awaitTermination()
    found = parse(read_files(spark, out), keep=["topic", "partition"], before=True)
    ids = [F.col(c).cast("bigint").alias(c) for c in ("row_id", "before_id")]
    return found.select("topic", "partition", "op", *ids)


@query
def job_counters(spark: SparkSession, folder: str) -> DataFrame:
    """The counters of a job over three starts, with new files before the last."""
    source, out = _stage(event_log(spark, folder), "events"), new_folder(spark, "counted")
    opts = Options(job_id="job_counters", partitions=4, checkpoint_dir=new_folder(spark, "job"))
    _drain(spark, source, opts, out)
    _drain(spark, source, opts, out)
    _append(wire_log(spark, folder), source)
    _drain(spark, source, opts, out)
    rows = sorted(job_totals(spark, opts).items())
    return spark.createDataFrame(rows, "counter string, records bigint")


@query
def job_latest_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """What came after the end of the log, from the files that reach past it alone."""
    wire = parse(wire_log(spark, folder), position=True)
    later = is_after(MARK, "")
    source, out = _stage(wire.where(~later).select("value"), "log"), new_folder(spark, "delivered")
    index = LogIndex(spark, source, new_folder(spark, "index"))
    end = index.end()
    _append(wire.where(later).select("value"), source)
    run_batch(index.read_after(end), FOUR.with_(start_after=end), files(out, by_partition=True, compression=PACKED))
    found = parse(read_files(spark, out), keep=["topic", "partition"], before=True)
    ids = [F.col(c).cast("bigint").alias(c) for c in ("row_id", "before_id")]
    return found.select("topic", "partition", "op", *ids)


@query
def snapshot_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot in four chunks while the log moves on, broken off in the third and begun again.

    The log grows by two stretches around each chunk, of which the chunk's rows show the
    first; the last two follow the snapshot.
    """
    changes = staged(moving_log(spark, folder), "moving")
    source, out, place = new_folder(spark, "log"), new_folder(spark, "delivered"), new_folder(spark, "chunks")

    def append(low: int, high: int) -> None:
        _append(encode(changes.where(F.col("stretch").between(low, high))), source)

    reads: list[int] = []

    def rows(chunk: Chunk) -> DataFrame:
        reads.append(chunk.number)
        if reads.count(2) == 1 and chunk.number == 2:
            raise ConnectionError("the database went away")
        seen = 3 + 2 * chunk.number
        append(seen, seen + 1)
        # As a database reads a range of keys: other rows' changes are left out before they are ranked.
        return replay(changes.where((F.col("stretch") <= seen) & chunk.holds(row_key("id")))).select("after.*")

    append(0, 2)
    last = read_parquet(spark, folder, "orders").agg(F.max("o_orderkey")).first()[0]
    table = ChunkedTable(rows, [last * i // 4 for i in (1, 2, 3)])
    index = LogIndex(spark, source, new_folder(spark, "index"))
    opts, target = FOUR.with_(databases="test"), files(out, by_partition=True, compression=PACKED)
    try:
        snapshot_chunks(index, opts, target, "test.tb_order", table, f"{place}/test.tb_order")
    except ConnectionError:
        snapshot_chunks(index, opts, target, "test.tb_order", table, f"{place}/test.tb_order")
    append(11, 12)
    capture_in_chunks(index, opts, target, {"test.tb_order": table}, place)
    return _flat(decode(read_files(spark, out), IMAGE)).drop("file", "pos")


# --- derived tables ----------------------------------------------------------


@query
def order_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows with every draw replaced by a function of the order key."""
    return order_rules.order_projection(drawn_orders(spark, folder))


@query
def order_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The full order table captured, converted by its declared types, written and read back."""
    rows = order_rules.order_rows(drawn_orders(spark, folder))
    converted = convert_row(rows, order_rules.ORDER_TYPES, zone="Asia/Shanghai")
    image = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in converted.schema.fields)
    records = encode(capture.snapshot(converted, "test", "tb_order", mark=MARK))
    return decode(records, image).select("after.*")


@query
def replay_state(spark: SparkSession, folder: str) -> DataFrame:
    """The current rows of both tables, from the record texts."""
    return replay(_typed_wire(spark, folder)).select("db", F.col("table").alias("tbl"), "after.*")


@query
def merge_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The current rows, merged from three batches in which a row's changes come in any order."""
    state = BucketedState(spark, new_folder(spark, "state"), IMAGE, buckets=16)
    changes = staged(_typed_wire(spark, folder), "changes")
    for batch, rest in enumerate((1, 2, 0)):
        state.merge(changes.where(F.col("source.pos") % 4 % 3 == rest), batch)
    return state.read().select("db", F.col("table").alias("tbl"), "after.*")


@query
def last_change_per_row(spark: SparkSession, folder: str) -> DataFrame:
    """The last operation on each row, deletes included."""
    last = last_changes(_typed_wire(spark, folder))
    return last.select("db", F.col("table").alias("tbl"), F.col("_key_id").alias("id"), "op")


@query
def replay_mixed_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The last record of every row in two logs of unlike tables, none of them decoded."""
    wire = wire_log(spark, folder).unionByName(event_log(spark, folder))
    last = replay_records(parse(wire, position=True, before=True))
    return last.select("db", F.col("table").alias("tbl"), F.col("row_id").cast("bigint").alias("id"), "op", "pos")


def _parsed_log(spark: SparkSession, folder: str, *wires: Callable[[SparkSession, str], DataFrame]) -> ParsedLog:
    log = ParsedLog(spark, new_folder(spark, "parsed"))
    for batch, wire in enumerate(wires):
        log.add(wire(spark, folder), batch)
    return log


@query
def parsed_log_route(spark: SparkSession, folder: str) -> DataFrame:
    """Topics and partitions from a log that is kept parsed."""
    records = _parsed_log(spark, folder, wire_log).records()
    return routing.fanout_counts(routed_records(records, FOUR))


@query
def parsed_log_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Both a plain name and a pattern, on a log that is kept parsed."""
    records = _parsed_log(spark, folder, wire_log).records()
    return _named(filters.include(records, tables=r"test\.tb_ord,CRM\.tb_.*"))


@query
def parsed_log_replay(spark: SparkSession, folder: str) -> DataFrame:
    """The last record of every row in two logs of unlike tables, kept parsed as one."""
    last = replay_records(_parsed_log(spark, folder, wire_log, event_log).records())
    return last.select("db", F.col("table").alias("tbl"), F.col("row_id").cast("bigint").alias("id"), "op", "pos")


@query
def parsed_log_state(spark: SparkSession, folder: str) -> DataFrame:
    """The current rows of both tables, from images that are kept as VARIANT."""
    changes = _parsed_log(spark, folder, wire_log).changes(IMAGE)
    return replay(changes).select("db", F.col("table").alias("tbl"), "after.*")
