"""Change logs and table versions derived from the given tables.

The log has the order table (inserts, updates, deletes), the customer table
(inserts) and one schema change per nation. Every row of the three tables takes
part, so the log grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.functions import values as V
from rowrelay.functions.record import encode, source_struct
from rowrelay.sources.tables import read_parquet

IMAGE = "id: bigint, status: string, price: double"
EPOCH_MS = 1704067200000

ORDERS_FILE = "binlog.000001"
CUSTOMER_FILE = "binlog.000002"
SCHEMA_FILE = "binlog.000003"


def _image(row_id: Column, status: Column, price: Column) -> Column:
    money = V.decimal_to_double(price.cast("decimal(14,2)"))
    return F.struct(row_id.alias("id"), status.alias("status"), money.alias("price"))


def _no_image() -> Column:
    return F.lit(None).cast("struct<id: bigint, status: string, price: double>")


def _event(op: str | None, before: Column, after: Column, pos: Column) -> Column:
    return F.struct(
        before.alias("before"), after.alias("after"), F.lit(op).cast("string").alias("op"), pos.alias("pos")
    )


def _log(events: DataFrame, db: str, table: Column, file: str) -> DataFrame:
    at = F.lit(EPOCH_MS) + F.col("pos") * 1000
    source = source_struct(F.lit(db), table, ts_ms=at, file=F.lit(file), pos=F.col("pos"))
    return events.select(
        "before",
        "after",
        source.alias("source"),
        "op",
        (at + 500).alias("ts_ms"),
        F.lit(None).cast("string").alias("transaction"),
    )


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """The change frame; each table is scanned once."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    price = F.col("o_totalprice").cast("decimal(14,2)")
    first = _image(key, status, price)
    second = _image(key, F.lit("X"), price + 1)
    updated, deleted = key % 3 == 0, key % 5 == 0
    events = F.array(
        _event("c", _no_image(), first, key * 4),
        F.when(updated, _event("u", first, second, key * 4 + 1)),
        F.when(deleted, _event("d", F.when(updated, second).otherwise(first), _no_image(), key * 4 + 2)),
    )
    orders = read_parquet(spark, folder, "orders").select(F.inline(F.array_compact(events)))

    customer = read_parquet(spark, folder, "customer").select(
        _no_image().alias("before"),
        _image(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal")).alias("after"),
        F.lit("c").alias("op"),
        (F.col("c_custkey") * 4).alias("pos"),
    )
    nation = read_parquet(spark, folder, "nation").select(
        _no_image().alias("before"),
        _no_image().alias("after"),
        F.lit(None).cast("string").alias("op"),
        (F.col("n_nationkey").cast("bigint") * 4).alias("pos"),
    )
    unnamed = F.when((F.col("pos") / 4) % 2 == 0, F.lit(""))
    return (
        _log(orders, "test", F.lit("tb_order"), ORDERS_FILE)
        .unionByName(_log(customer, "crm", F.lit("tb_customer"), CUSTOMER_FILE))
        .unionByName(_log(nation, "test", unnamed, SCHEMA_FILE))
    )


def truncates(spark: SparkSession, folder: str) -> DataFrame:
    """The order table's truncates as record texts, one per region."""
    region = read_parquet(spark, folder, "region").select(
        _no_image().alias("before"),
        _no_image().alias("after"),
        F.lit("t").alias("op"),
        (F.col("r_regionkey").cast("bigint") * 1000 + 3).alias("pos"),
    )
    return encode(_log(region, "test", F.lit("tb_order"), ORDERS_FILE))


def wire_log(spark: SparkSession, folder: str) -> DataFrame:
    """The change log as record texts."""
    return encode(change_log(spark, folder))


#: Places of the updates and deletes of the moving log, in a file each, and a sixth of them.
PLACES = 4 * 1000003
SIXTH = PLACES // 6 + 1


def moving_log(spark: SparkSession, folder: str) -> DataFrame:
    """A log of the order table in which a row's changes lie far apart: inserts, then updates, then deletes.

    ``stretch`` numbers the log's stretches in its order: 0 has the inserts, 1 to 6 a sixth
    of the updates each, and 7 to 12 a sixth of the deletes.
    """
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    price = F.col("o_totalprice").cast("decimal(14,2)")
    first, second = _image(key, status, price), _image(key, F.lit("X"), price + 1)
    updated, deleted = key % 3 == 0, key % 5 == 0
    kinds = [
        (ORDERS_FILE, F.lit(True), _event("c", _no_image(), first, key * 4), 0),
        (CUSTOMER_FILE, updated, _event("u", first, second, key * 48271 % 1000003 * 4), 1),
        (SCHEMA_FILE, deleted, _event("d", F.when(updated, second).otherwise(first), _no_image(), key * 69621 % 1000003 * 4), 7),
    ]
    logs = []
    for file, some, event, begin in kinds:
        rows = _log(read_parquet(spark, folder, "orders").where(some).select(F.inline(F.array(event))), "test", F.lit("tb_order"), file)
        stretch = F.call_function("div", F.col("source.pos"), F.lit(SIXTH).cast("bigint")) if begin else F.lit(0)
        logs.append(rows.withColumn("stretch", (begin + stretch).cast("int")))
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


def versioned_log(spark: SparkSession, folder: str) -> DataFrame:
    """Record texts of the order table while its columns change, once per region.

    A region's number counts the columns added so far; ``status`` goes with the third.
    """
    orders = read_parquet(spark, folder, "orders")
    regions = read_parquet(spark, folder, "region").select(F.col("r_regionkey").cast("bigint").alias("v"))
    last, versions = orders.agg(F.max("o_orderkey")).first()[0] or 0, 5
    key, v = F.col("o_orderkey"), F.call_function("div", F.col("o_orderkey") * versions, F.lit(last + 1))
    names = [("id", F.lit(True)), ("status", F.col("v") < 3), *[(f"c{i}", F.col("v") >= i) for i in range(1, versions)]]
    values = {"id": key, "status": F.col("o_orderstatus"), **{f"c{i}": key % (6 + i) for i in range(1, versions)}}

    def source(pos: Column) -> Column:
        return source_struct(F.lit("test"), F.lit("tb_order"), ts_ms=F.lit(EPOCH_MS), file=F.lit(ORDERS_FILE), pos=pos).alias("source")

    rows = orders.withColumn("v", v)
    image = F.struct(*[F.when(there, values[n]).alias(n) for n, there in names])
    changes = rows.select(F.to_json(F.struct(image.alias("after"), source(key * 4), F.lit("c").alias("op"))).alias("value"))
    every = F.array(*[F.when(there, F.struct(F.lit(n).alias("name"), F.lit(i + 1).alias("position"), F.lit("TEXT" if n == "status" else "BIGINT").alias("typeName"))) for i, (n, there) in enumerate(names)])
    table = F.struct(F.lit("ALTER").alias("type"), F.lit('"test"."tb_order"').alias("id"), F.struct(F.array_compact(every).alias("columns")).alias("table"))
    begin = F.call_function("div", F.col("v") * (last + 1) + versions - 1, F.lit(versions)) * 4 - 1
    lists = regions.select(F.to_json(F.struct(source(begin), F.array(table).alias("tableChanges"))).alias("value"))
    return changes.unionByName(lists)


def order_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The order table before and after: low priorities removed, finished orders
    changed, and a second order added for each urgent one."""
    orders = read_parquet(spark, folder, "orders")
    money = F.col("o_totalprice").cast("decimal(14,2)")
    old = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        money.alias("price"),
        F.col("o_orderdate").alias("created_time"),
    )
    finished, priority = F.col("o_orderstatus") == "F", F.col("o_orderpriority")

    def row(row_id: Column, status: Column, price: Column) -> Column:
        return F.struct(
            row_id.alias("id"),
            F.col("o_custkey").alias("user_id"),
            status.alias("status"),
            price.cast("decimal(14,2)").alias("price"),
            F.col("o_orderdate").alias("created_time"),
        )

    kept = row(
        F.col("o_orderkey"),
        F.when(finished, "X").otherwise(F.col("o_orderstatus")),
        F.when(finished, money + 1).otherwise(money),
    )
    added = row(-1 - F.col("o_orderkey"), F.lit("N"), money)
    rows = F.array(F.when(priority != "5-LOW", kept), F.when(priority == "1-URGENT", added))
    return old, orders.select(F.inline(F.array_compact(rows)))


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as record texts: one table per event type, one insert per event."""
    events = read_parquet(spark, folder, "events")
    image = F.struct(
        F.col("event_id").alias("id"),
        V.datetime_to_string(F.col("ts"), events.schema["ts"].dataType).alias("ts"),
        "user_id",
        "value",
        "props",
    )
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    changes = events.select(
        F.when(F.lit(False), image).alias("before"),
        image.alias("after"),
        source_struct(
            F.lit("app"),
            F.concat(F.lit("ev_"), F.col("event_type")),
            ts_ms=at,
            file=F.lit(ORDERS_FILE),
            pos=F.col("event_id") * 100,
        ).alias("source"),
        F.lit("c").alias("op"),
        at.alias("ts_ms"),
        F.lit(None).cast("string").alias("transaction"),
    )
    return encode(changes)


def drawn_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Draws for the sample order table, each a function of the order key."""
    key = F.col("o_orderkey")
    draws = {
        "id": key,
        "user_id": F.col("o_custkey") + 10000,
        "goods_id": key % 90000 + 10000,
        "amount": key % 10 + 1,
        "coupon_id": key * 7 % 90000 + 10000,
        "freight_steps": key % 5 + 1,
        "status": key % 6 + 1,
        "created_time": F.col("o_orderdate"),
        "pay_wait": key % 291 + 10,
        "send_wait": key % 70001 + 16400,
        "finish_wait": key * 3 % 70001 + 16400,
        "shop_id": key % 3001 + 1000,
        "pay_channel": key % 4 + 1,
        "order_draw": key % 90000 + 10000,
        "third_draw": key % 9000000 + 1000000,
        "remark_draw": key % 9000 + 1000,
        "pay_draw": key + 100000000,
    }
    return read_parquet(spark, folder, "orders").select(*[c.alias(n) for n, c in draws.items()])
