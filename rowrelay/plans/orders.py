"""The sample order table: derived columns and full rows, as projections."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules of the sample order table
INVITER_MODULUS = 44444
PRICE_DIVISOR = 1000
CATEGORY_DIVISOR = 100
GOODS_NAME_PREFIX = "goodsName"
COUPON_NAME_PREFIX = "优惠劵"
REMARK_PREFIX = "用户备注"
PAY_ORDER_PREFIX = "P"
COUPON_MODULUS = 9
FREIGHT_STEP = 10
ADDRESS_OFFSET = 30000
STATUS_PAID = 2
STATUS_SENT = 4
STATUS_FINISHED = 5

# Columns and types of the sample order table
ORDER_COLUMNS = """
id int
order_no varchar(32)
third_order_no varchar(32)
user_id int
inviter_id int
shop_id int
goods_id int
goods_cate_id int
goods_name varchar(64)
price decimal(14,2)
amount int
total_price decimal(14,2)
created_time timestamp
coupon_name varchar(64)
pay_channel int
coupon_id int
status int
user_remark varchar(256)
freight_charge decimal(14,2)
pay_amount decimal(14,2)
pay_order_no varchar(32)
address_id int
pay_time timestamp
updated_time timestamp
send_out_time timestamp
finished_time timestamp
coupon_amount decimal(14,2)
order_month int
change_time timestamp
create_date varchar(20)
"""
ORDER_TYPES = dict(line.split() for line in ORDER_COLUMNS.strip().splitlines())


def _spark_type(sql_type: str) -> str:
    if sql_type.startswith("varchar"):
        return "string"
    return "timestamp_ntz" if sql_type == "timestamp" else sql_type


def _later(moment: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, moment)


def _derived(drawn: DataFrame) -> DataFrame:
    """The draws with the columns that follow from them."""
    c = F.col
    first = drawn.select(
        "*",
        (c("user_id") % INVITER_MODULUS).alias("inviter_id"),
        (c("user_id") + ADDRESS_OFFSET).alias("address_id"),
        F.floor(c("goods_id") / CATEGORY_DIVISOR).cast("bigint").alias("goods_cate_id"),
        F.concat(F.lit(GOODS_NAME_PREFIX), c("goods_id").cast("string")).alias("goods_name"),
        (c("goods_id").cast("double") / PRICE_DIVISOR).alias("price"),
        (c("coupon_id") % COUPON_MODULUS).alias("coupon_amount"),
        (c("freight_steps") * FREIGHT_STEP).alias("freight_charge"),
        F.when(c("status") >= STATUS_PAID, _later(c("created_time"), c("pay_wait"))).alias("pay_time"),
    )
    sent = F.when(c("status") >= STATUS_SENT, _later(c("pay_time"), c("send_wait")))
    second = first.select("*", (c("price") * c("amount")).alias("total_price"), sent.alias("send_out_time"))
    finished = F.when(c("status") >= STATUS_FINISHED, _later(c("send_out_time"), c("finish_wait")))
    updated = F.when(c("status") >= STATUS_SENT, c("send_out_time")).otherwise(c("pay_time"))
    return second.select(
        "*",
        (c("total_price") - c("coupon_amount") + c("freight_charge")).alias("pay_amount"),
        finished.alias("finished_time"),
        updated.alias("updated_time"),
    )


def order_projection(drawn: DataFrame) -> DataFrame:
    """The derived columns of order rows from drawn values.

    Input: ``id, user_id, goods_id, amount, coupon_id, freight_steps, status,
    created_time`` and the waiting times ``pay_wait, send_wait, finish_wait`` in
    seconds. Times a status has not reached yet are null. The update time of a
    finished order stays the time it was sent.
    """
    return _derived(drawn).select(
        "id",
        "user_id",
        "inviter_id",
        "goods_id",
        "goods_cate_id",
        "goods_name",
        "price",
        "amount",
        "total_price",
        "coupon_id",
        "coupon_amount",
        "freight_charge",
        "pay_amount",
        "address_id",
        "status",
        "created_time",
        "pay_time",
        "send_out_time",
        "finished_time",
        "updated_time",
    )


def order_rows(drawn: DataFrame) -> DataFrame:
    """Full rows of the order table, in its columns' order and types.

    Takes the input of :func:`order_projection` and the draws ``shop_id``,
    ``pay_channel``, ``order_draw``, ``third_draw``, ``remark_draw`` and
    ``pay_draw``. Money is computed in exact thousandths and rounded to cents once
    per column, as the column type does on insert. Columns no rule fills have the
    table's defaults; the change time is the last time the row was touched.
    """
    c = F.col

    def text(*parts: Column) -> Column:
        return F.concat(*[p.cast("string") for p in parts])

    # yyyyMMddHHmmss; date_format would read the time in the session zone
    stamp = F.translate(F.substring(c("created_time").cast("string"), 1, 19), "-: ", "")
    price = c("goods_id").cast("decimal(14,0)") * F.lit(Decimal(1) / PRICE_DIVISOR)
    total = price * c("amount").cast("decimal(4,0)")
    extras = c("freight_charge").cast("decimal(6,0)") - c("coupon_amount").cast("decimal(6,0)")
    made = {
        "order_no": text(stamp, c("order_draw")),
        "third_order_no": text(stamp, c("third_draw")),
        "price": price,
        "total_price": total,
        "pay_amount": total + extras,
        "coupon_name": text(F.lit(COUPON_NAME_PREFIX), c("coupon_id")),
        "user_remark": text(F.lit(REMARK_PREFIX), c("user_id"), c("remark_draw")),
        "pay_order_no": text(F.lit(PAY_ORDER_PREFIX), c("pay_draw")),
        "order_month": F.lit(0),
        "change_time": F.coalesce("updated_time", "created_time"),
        "create_date": F.lit(""),
    }
    columns = [made.get(n, c(n)).cast(_spark_type(t)).alias(n) for n, t in ORDER_TYPES.items()]
    return _derived(drawn).select(*columns)
