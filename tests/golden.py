"""The sample update record of the order table."""

import json

# The sample record
IMAGE = {
    "id": 1,
    "order_no": "2222",
    "third_order_no": "4324234",
    "user_id": 222,
    "inviter_id": 22,
    "shop_id": 222,
    "goods_id": 0,
    "goods_cate_id": 0,
    "goods_name": "",
    "price": 0.0,
    "amount": 0,
    "total_price": 0.0,
    "created_time": None,
    "coupon_name": "",
    "pay_channel": 0,
    "coupon_id": 0,
    "status": 0,
    "user_remark": "",
    "freight_charge": 0.0,
    "pay_amount": 0.0,
    "pay_order_no": "",
    "address_id": 0,
    "pay_time": None,
    "updated_time": None,
    "send_out_time": None,
    "finished_time": None,
    "coupon_amount": 0.0,
    "order_month": 0,
    "change_time": "2023-09-08 15:23:03",
    "create_date": "",
}
SOURCE = {
    "version": "1.6.4.Final",
    "connector": "mysql",
    "name": "mysql_binlog_source",
    "ts_ms": 1694186699000,
    "snapshot": "false",
    "db": "test",
    "sequence": None,
    "table": "tb_order",
    "server_id": 1,
    "gtid": None,
    "file": "host-bin.000005",
    "pos": 909,
    "row": 0,
    "thread": None,
    "query": None,
}
RECORD = {
    "before": IMAGE,
    "after": {**IMAGE, "user_id": 3333, "change_time": "2023-09-08 15:24:59"},
    "source": SOURCE,
    "op": "u",
    "ts_ms": 1694186703443,
    "transaction": None,
}
IMAGE_DDL = (
    "id: int, order_no: string, third_order_no: string, user_id: int, inviter_id: int, shop_id: int, "
    "goods_id: int, goods_cate_id: int, goods_name: string, price: double, amount: int, "
    "total_price: double, created_time: string, coupon_name: string, pay_channel: int, coupon_id: int, "
    "status: int, user_remark: string, freight_charge: double, pay_amount: double, "
    "pay_order_no: string, address_id: int, pay_time: string, updated_time: string, "
    "send_out_time: string, finished_time: string, coupon_amount: double, order_month: int, "
    "change_time: string, create_date: string"
)


def text(record=RECORD):
    return json.dumps(record, separators=(",", ":"), ensure_ascii=False)
