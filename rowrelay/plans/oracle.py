"""The registered queries as plain SQL over the given tables, written for DuckDB."""

from __future__ import annotations

# The change log: one row per record, with the row images as columns.
CHANGES = """
changes AS (
  SELECT 'binlog.000001' AS file, o_orderkey * 4 AS pos, 'test' AS db, 'tb_order' AS tbl, 'c' AS op,
    CAST(NULL AS BIGINT) AS before_id, CAST(NULL AS VARCHAR) AS before_status, CAST(NULL AS DOUBLE) AS before_price,
    o_orderkey AS after_id, o_orderstatus AS after_status,
    CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS after_price
  FROM orders
  UNION ALL
  SELECT 'binlog.000001', o_orderkey * 4 + 1, 'test', 'tb_order', 'u',
    o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE),
    o_orderkey, 'X', CAST(CAST(CAST(o_totalprice AS DECIMAL(14,2)) + 1 AS DECIMAL(14,2)) AS DOUBLE)
  FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT 'binlog.000001', o_orderkey * 4 + 2, 'test', 'tb_order', 'd',
    o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END,
    CAST(CAST(CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) + 1
      ELSE CAST(o_totalprice AS DECIMAL(14,2)) END AS DECIMAL(14,2)) AS DOUBLE),
    NULL, NULL, NULL
  FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL
  SELECT 'binlog.000002', c_custkey * 4, 'crm', 'tb_customer', 'c', NULL, NULL, NULL,
    c_custkey, c_mktsegment, CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS DOUBLE)
  FROM customer
  UNION ALL
  SELECT 'binlog.000003', CAST(n_nationkey AS BIGINT) * 4, 'test',
    CASE WHEN n_nationkey % 2 = 0 THEN '' END, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM nation
)"""

EPOCH_MS = 1704067200000

# Topic and partition of each change, with four partitions per topic.
ROUTED = (
    CHANGES
    + """,
routed AS (
  SELECT *, CASE WHEN coalesce(db, '') <> '' AND coalesce(tbl, '') <> ''
      THEN 'mysqlbinlog_' || db || '_' || tbl ELSE 'mysqlbinlog_ddl' END AS topic,
    CAST(coalesce(after_id, 0) % 4 AS INTEGER) AS part
  FROM changes
)"""
)

# The order rows at the mark (first log file, position 30000), then everything later.
HANDOFF = (
    CHANGES
    + """,
past AS (
  SELECT *, row_number() OVER (PARTITION BY coalesce(after_id, before_id) ORDER BY pos DESC) AS rn
  FROM changes WHERE tbl = 'tb_order' AND pos <= 30000
),
at_mark AS (
  SELECT 'binlog.000001' AS file, CAST(30000 AS BIGINT) AS pos, db, tbl, 'r' AS op,
    CAST(NULL AS BIGINT) AS before_id, after_id, after_status, after_price
  FROM past WHERE rn = 1 AND op <> 'd'
),
later AS (
  SELECT file, pos, db, tbl, op, before_id, after_id, after_status, after_price FROM changes
  WHERE file > 'binlog.000001' OR pos > 30000
),
handoff AS (SELECT * FROM at_mark UNION ALL SELECT * FROM later)"""
)

# The order table's inserts, updates and deletes, by stretches of the log and chunks of the key.
MOVING = """
bounds AS (SELECT max(o_orderkey) AS last FROM orders),
keyed AS (SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(14,2)) AS price,
    CASE WHEN o_orderkey < last // 4 THEN 0 WHEN o_orderkey < last * 2 // 4 THEN 1 WHEN o_orderkey < last * 3 // 4 THEN 2 ELSE 3 END AS chunk
  FROM orders, bounds),
moving AS (
  SELECT id, chunk, 0 AS stretch, id * 4 AS pos, 'c' AS op, CAST(NULL AS BIGINT) AS before_id, id AS after_id, status AS after_status,
    CAST(price AS DOUBLE) AS after_price FROM keyed
  UNION ALL
  SELECT id, chunk, 1 + (id * 48271 % 1000003 * 4) // 666669, id * 48271 % 1000003 * 4, 'u', id, id, 'X', CAST(CAST(price + 1 AS DECIMAL(14,2)) AS DOUBLE)
  FROM keyed WHERE id % 3 = 0
  UNION ALL
  SELECT id, chunk, 7 + (id * 69621 % 1000003 * 4) // 666669, id * 69621 % 1000003 * 4, 'd', id, NULL, NULL, NULL
  FROM keyed WHERE id % 5 = 0
)"""

FLAT = "file, pos, db, tbl, op, before_id, after_id, after_status, after_price"

ORDER_VERSIONS = """
old_rows AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS status,
    CAST(o_totalprice AS DECIMAL(14,2)) AS price, o_orderdate AS created_time FROM orders
),
new_rows AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS status,
    CAST(CAST(o_totalprice AS DECIMAL(14,2)) + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DECIMAL(14,2)) AS price,
    o_orderdate AS created_time
  FROM orders WHERE o_orderpriority <> '5-LOW'
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, 'N', CAST(o_totalprice AS DECIMAL(14,2)), o_orderdate
  FROM orders WHERE o_orderpriority = '1-URGENT'
)"""


# Order rows from functions of the key, step by step.
ORDER_STEPS = """
drawn AS (
  SELECT o_orderkey AS id, 10000 + o_custkey AS user_id, 10000 + o_orderkey % 90000 AS goods_id,
    1 + o_orderkey % 10 AS amount, 10000 + (o_orderkey * 7) % 90000 AS coupon_id, 1 + o_orderkey % 6 AS status,
    10 * (1 + o_orderkey % 5) AS freight_charge, o_orderdate AS created_time FROM orders),
paid AS (SELECT *, CAST(goods_id AS DOUBLE) / 1000 AS price,
    CASE WHEN status >= 2 THEN created_time + (10 + id % 291) * INTERVAL '1' SECOND END AS pay_time FROM drawn),
sent AS (SELECT *, price * amount AS total_price, coupon_id % 9 AS coupon_amount,
    CASE WHEN status >= 4 THEN pay_time + (16400 + id % 70001) * INTERVAL '1' SECOND END AS send_out_time FROM paid),
final AS (SELECT *,
    CASE WHEN status >= 5 THEN send_out_time + (16400 + (id * 3) % 70001) * INTERVAL '1' SECOND END AS finished_time,
    CASE WHEN status >= 4 THEN send_out_time WHEN status >= 2 THEN pay_time END AS updated_time FROM sent)"""


def _cents(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(14,2)) AS DOUBLE)"


def _shanghai(expression: str) -> str:
    return _local_time(f"({expression})", "Asia/Shanghai")


def _low32(expression: str) -> str:
    """The low 32 bits of a HUGEINT expression as a signed integer."""
    return (
        f"CAST(((({expression}) % 4294967296 + 4294967296 + 2147483648) % 4294967296) - 2147483648 AS INTEGER)"
    )


def _slot(expression: str, count: int) -> str:
    return f"CAST((({expression}) % {count} + {count}) % {count} AS INTEGER)"


def _local_time(column: str, zone: str) -> str:
    return f"CAST(timezone('{zone}', timezone('UTC', {column})) AS VARCHAR)"


EVENT_ROUTES = """
  SELECT event_id AS row_id, 'mysqlbinlog_app_ev_' || event_type AS topic,
    CAST(event_id % {n} AS INTEGER) AS "partition" FROM events"""


def all_oracles() -> dict[str, str]:
    wrap_values = """
  SELECT o_orderkey, CAST(o_orderkey AS HUGEINT) * 12345678901234567 AS v FROM orders
  UNION ALL SELECT o_orderkey, CAST(o_orderkey AS HUGEINT) * 715827883 - 5000000000000 FROM orders
  UNION ALL SELECT o_orderkey, -CAST(o_orderkey AS HUGEINT) * 12345678901234567 FROM orders"""
    wide_ids = """
  SELECT o_orderkey, CAST('123456789012345' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS HUGEINT) AS v FROM orders
  UNION ALL SELECT o_orderkey, CAST(o_orderkey AS HUGEINT) FROM orders"""
    unsigned = "CAST(o_orderkey AS HUGEINT) * 1152921504606846993 % 18446744073709551616"
    newest = """
  SELECT *, row_number() OVER (PARTITION BY db, tbl, coalesce(after_id, before_id) ORDER BY file DESC, pos DESC) AS rn
  FROM {log} WHERE op IS NOT NULL"""
    job = """WITH {log}
SELECT CASE WHEN coalesce(db, '') <> '' AND coalesce(tbl, '') <> ''
    THEN 'mysqlbinlog_' || db || '_' || tbl ELSE 'mysqlbinlog_ddl' END AS topic,
  CAST(coalesce(after_id, 0) % 4 AS INTEGER) AS "partition", op, after_id AS row_id, before_id FROM {name}"""
    found = {
        "routed_counts": f"""WITH {ROUTED}
SELECT topic, part AS "partition", op, count(*) AS records FROM routed GROUP BY topic, part, op""",
        "snapshot_capture": f"""
SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS status,
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS price, CAST(o_orderdate AS VARCHAR) AS created_time,
  o_orderpriority AS priority, TRUE AS no_before, 'test' AS db, 'tb_order' AS tbl, 'true' AS snapshot,
  CAST(30000 AS BIGINT) AS pos, 'r' AS op, CAST({EPOCH_MS} AS BIGINT) AS ts_ms
FROM orders""",
        "snapshot_unsigned": """
SELECT o_orderkey, CAST(CASE WHEN CAST(o_orderkey AS HUGEINT) * 9007199254740993 % 18446744073709551616 >= 9223372036854775808
  THEN CAST(o_orderkey AS HUGEINT) * 9007199254740993 % 18446744073709551616 - 18446744073709551616
  ELSE CAST(o_orderkey AS HUGEINT) * 9007199254740993 % 18446744073709551616 END AS BIGINT) AS id FROM orders""",
        "latest_changes": f"""WITH {CHANGES}
SELECT {FLAT} FROM changes WHERE file > 'binlog.000001' OR pos > 30000""",
        "timestamp_start": f"""WITH {CHANGES}
SELECT {FLAT} FROM changes WHERE {EPOCH_MS} + pos * 1000 >= {EPOCH_MS + 30000 * 1000}""",
        "log_end": f"""WITH {CHANGES}
SELECT CAST(right(file, 6) AS BIGINT) AS sequence, pos, CAST(0 AS INTEGER) AS row_no
FROM changes ORDER BY file DESC, pos DESC LIMIT 1""",
        "start_mode_initial": f"WITH {HANDOFF} SELECT {FLAT} FROM handoff",
        "start_mode_latest": f"WITH {HANDOFF} SELECT {FLAT} FROM later",
        "start_mode_timestamp": f"""WITH {CHANGES}
SELECT {FLAT} FROM changes WHERE pos >= 30000""",
        "snapshot_then_changes": f"""WITH {CHANGES}, newest AS ({newest.format(log="changes")})
SELECT db, tbl, after_id AS id, after_status AS status, after_price AS price FROM newest
WHERE rn = 1 AND op <> 'd'""",
        "filter_databases": f"""WITH {CHANGES}
SELECT file, pos, db, tbl, op FROM changes WHERE regexp_full_match(db, '(crm)|(te)', 'i')""",
        "filter_tables": rf"""WITH {CHANGES}
SELECT file, pos, db, tbl, op FROM changes
WHERE coalesce(tbl, '') = '' OR regexp_full_match(db || '.' || tbl, '(test\.tb_ord)|(CRM\.tb_.*)', 'i')""",
        "schema_change_records": f"""WITH {CHANGES}
SELECT file, pos, db, tbl, op FROM changes WHERE db = 'test'""",
        "schema_changes_off": f"""WITH {CHANGES}
SELECT file, pos, db, tbl, op FROM changes WHERE db = 'test' AND op IS NOT NULL""",
        "table_diff": f"""WITH {ORDER_VERSIONS}
SELECT CASE WHEN o.id IS NULL THEN 'c' WHEN n.id IS NULL THEN 'd' ELSE 'u' END AS op,
  o.id AS before_id, o.user_id AS before_user_id, o.status AS before_status, CAST(o.price AS DOUBLE) AS before_price,
  n.id AS after_id, n.user_id AS after_user_id, n.status AS after_status, CAST(n.price AS DOUBLE) AS after_price
FROM old_rows o FULL OUTER JOIN new_rows n ON o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL OR o.user_id IS DISTINCT FROM n.user_id OR o.status IS DISTINCT FROM n.status
  OR o.price IS DISTINCT FROM n.price OR o.created_time IS DISTINCT FROM n.created_time""",
        "diff_by_ranges": f"""WITH {ORDER_VERSIONS}, near_rows AS (
  SELECT * FROM old_rows WHERE id // 100 % 100 <> 40 UNION ALL SELECT * FROM new_rows WHERE id // 100 % 100 = 40)
SELECT CASE WHEN o.id IS NULL THEN 'c' WHEN n.id IS NULL THEN 'd' ELSE 'u' END AS op,
  o.id AS before_id, o.user_id AS before_user_id, o.status AS before_status, CAST(o.price AS DOUBLE) AS before_price,
  n.id AS after_id, n.user_id AS after_user_id, n.status AS after_status, CAST(n.price AS DOUBLE) AS after_price
FROM old_rows o FULL OUTER JOIN near_rows n ON o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL OR o.user_id IS DISTINCT FROM n.user_id OR o.status IS DISTINCT FROM n.status
  OR o.price IS DISTINCT FROM n.price OR o.created_time IS DISTINCT FROM n.created_time""",
        "diff_applied": f"""WITH {ORDER_VERSIONS}
SELECT id, user_id, status, CAST(price AS DOUBLE) AS price, created_time FROM new_rows""",
        "apply_mixed_log": f"""WITH {ORDER_VERSIONS}
SELECT id, user_id, status, CAST(price AS DOUBLE) AS price, created_time FROM new_rows""",
        "replay_truncate": f"""WITH {CHANGES}, kept AS (
  SELECT * FROM changes WHERE tbl IS DISTINCT FROM 'tb_order' OR pos > (SELECT max(r_regionkey) * 1000 + 3 FROM region)),
newest AS ({newest.format(log="kept")})
SELECT db, tbl, after_id AS id, after_status AS status, after_price AS price FROM newest WHERE rn = 1 AND op <> 'd'""",
        "envelope_roundtrip": f"""WITH {CHANGES}
SELECT before_id, before_status, before_price, after_id, after_status, after_price, 'mysql' AS connector,
  'false' AS snapshot, db, tbl, file, pos, CAST(0 AS INTEGER) AS row_no, {EPOCH_MS} + pos * 1000 AS source_ts_ms,
  CAST(NULL AS VARCHAR) AS gtid, op, {EPOCH_MS} + pos * 1000 + 500 AS ts_ms, CAST(NULL AS VARCHAR) AS transaction
FROM changes""",
        "envelope_fields": f"""WITH {CHANGES}
SELECT 'before,after,source,op,ts_ms,transaction' AS fields, count(*) AS records FROM changes""",
        "decimal_to_double": """
SELECT l_orderkey, l_partkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS price
FROM lineitem""",
        "unsigned_to_long": f"""
SELECT o_orderkey, CAST(CASE WHEN {unsigned} >= 9223372036854775808 THEN {unsigned} - 18446744073709551616
  ELSE {unsigned} END AS BIGINT) AS signed_value FROM orders""",
        "date_to_string": """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "day",
  CAST(DATE '1970-01-01' + CAST(l_partkey * 7 - 500 AS INTEGER) AS VARCHAR) AS day_count
FROM lineitem""",
        "time_to_string": "SELECT event_id, CAST(CAST(ts AS TIME) AS VARCHAR) AS time_text FROM events",
        "datetime_to_string": "SELECT event_id, CAST(ts AS VARCHAR) AS datetime_text FROM events",
        "timestamp_to_local": f"""
SELECT 'events' AS origin, event_id AS id, {_local_time("ts", "Asia/Shanghai")} AS from_utc,
  {_local_time("ts", "Asia/Shanghai")} AS from_instant FROM events
UNION ALL
SELECT 'orders', o_orderkey, {_local_time("o_orderdate", "America/New_York")},
  {_local_time("o_orderdate", "America/New_York")} FROM orders""",
        "convert_row_types": f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS money,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "day", CAST(l_shipdate AS VARCHAR) AS moment,
  {_local_time("(l_shipdate + l_partkey * INTERVAL '1' SECOND)", "Asia/Shanghai")} AS instant,
  CAST(TIME '00:00:00' + l_linenumber * INTERVAL '1' MINUTE + CAST(l_quantity AS BIGINT) * INTERVAL '1' SECOND AS VARCHAR) AS clock,
  CAST(CAST(l_orderkey AS HUGEINT) - 9223372036854775808 AS BIGINT) AS unsigned,
  CAST(1990 + l_linenumber AS INTEGER) AS year_no, l_returnflag AS flag
FROM lineitem""",
        "convert_nulls": """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) END AS money,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS "day",
  CASE WHEN o_orderstatus = 'F' THEN '00:00:00' END AS clock,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS VARCHAR) END AS moment,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS VARCHAR) END AS instant,
  CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS unsigned,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) END AS day_other,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS clock_other,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS moment_other,
  CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey > 500 THEN 'true' ELSE 'false' END END AS instant_other
FROM orders""",
        "parse_source": f"WITH {CHANGES} SELECT file, pos, db, tbl, op FROM changes",
        "extract_row_id": f"WITH {CHANGES} SELECT file, pos, after_id AS row_id FROM changes",
        "extract_wide_id": f"""WITH ids AS ({wide_ids})
SELECT o_orderkey, CAST(v AS VARCHAR) AS row_id, {_low32("v")} AS id32 FROM ids""",
        "route_topic": f"WITH {ROUTED} SELECT file, pos, topic FROM routed",
        "route_fallback": """WITH named AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'test' END AS db,
    CASE WHEN o_orderpriority < '3' THEN 'tb_order' WHEN o_orderpriority < '5' THEN '' END AS tbl FROM orders)
SELECT o_orderkey, db, tbl, CASE WHEN db <> '' AND tbl <> '' THEN 'mysqlbinlog_' || db || '_' || tbl
  ELSE 'mysqlbinlog_ddl' END AS topic FROM named""",
        "fanout_counts": f"""WITH routes AS ({EVENT_ROUTES.format(n=8)})
SELECT topic, "partition", 'c' AS op, count(*) AS records FROM routes GROUP BY topic, "partition" """,
        "partition_by_id": f"""WITH {ROUTED} SELECT file, pos, topic, part AS "partition" FROM routed""",
        "partition_by_topic_count": f"""WITH {ROUTED}
SELECT file, pos, topic, CAST(coalesce(after_id, 0) % CASE WHEN topic = 'mysqlbinlog_test_tb_order' THEN 7 ELSE 3 END
  AS INTEGER) AS "partition" FROM routed""",
        "partition_by_many_topics": f"""WITH {ROUTED}
SELECT file, pos, topic, CAST(coalesce(after_id, 0) % CASE topic WHEN 'mysqlbinlog_test_tb_order' THEN 7
  WHEN 'mysqlbinlog_crm_tb_customer' THEN 5 ELSE 3 END AS INTEGER) AS "partition" FROM routed""",
        "partition_deletes": f"""WITH {ROUTED}
SELECT file, pos, op, topic, CAST(0 AS INTEGER) AS "partition" FROM routed WHERE after_id IS NULL""",
        "partition_deletes_by_before_id": f"""WITH {ROUTED}
SELECT file, pos, op, topic, CAST(coalesce(after_id, before_id, 0) % 4 AS INTEGER) AS "partition" FROM routed""",
        "id_wrap": f"""WITH ids AS ({wrap_values})
SELECT o_orderkey, CAST(v AS VARCHAR) AS row_id, {_low32("v")} AS id32,
  {_slot(_low32("v"), 7)} AS "partition" FROM ids""",
        "partition_order": f"""WITH {ROUTED}
SELECT topic, part AS "partition", file, pos,
  row_number() OVER (PARTITION BY topic, part ORDER BY file, pos) - 1 AS sequence FROM routed""",
        "waves_order": f"""WITH {ROUTED}
SELECT topic, part AS "partition", file, pos,
  row_number() OVER (PARTITION BY topic, part ORDER BY file, pos) - 1 AS sequence FROM routed""",
        "kafka_record": f"""WITH {ROUTED}
SELECT topic, part AS "partition", file, pos, after_id AS row_id, op, TRUE AS key_is_value
FROM routed""",
        "pulsar_record": f"""WITH {ROUTED}
SELECT topic, file, pos, after_id AS row_id, op FROM routed""",
        "stream_route": EVENT_ROUTES.format(n=4),
        "stream_resume": f"""WITH {ROUTED} {EVENT_ROUTES.format(n=4)}
UNION ALL SELECT after_id, topic, part FROM routed""",
        "job_initial": job.format(log=HANDOFF, name="handoff"),
        "job_latest": job.format(log=HANDOFF, name="later"),
        "schema_timeline": """WITH keyed AS (
  SELECT o_orderkey AS k, o_orderstatus AS s, (o_orderkey * 5) // (SELECT max(o_orderkey) + 1 FROM orders) AS v FROM orders)
SELECT k * 4 AS pos, 'c' AS op,
  CASE WHEN v < 3 THEN 'id,status' ELSE 'id' END || CASE WHEN v >= 1 THEN ',c1' ELSE '' END || CASE WHEN v >= 2 THEN ',c2' ELSE '' END || CASE WHEN v >= 3 THEN ',c3' ELSE '' END || CASE WHEN v >= 4 THEN ',c4' ELSE '' END AS names,
  CASE WHEN v < 3 THEN 'BIGINT,TEXT' ELSE 'BIGINT' END || repeat(',BIGINT', CAST(v AS BIGINT)) AS types,
  CAST(k AS VARCHAR) || CASE WHEN v < 3 THEN ',' || s ELSE '' END || CASE WHEN v >= 1 THEN ',' || CAST(k % 7 AS VARCHAR) ELSE '' END || CASE WHEN v >= 2 THEN ',' || CAST(k % 8 AS VARCHAR) ELSE '' END || CASE WHEN v >= 3 THEN ',' || CAST(k % 9 AS VARCHAR) ELSE '' END || CASE WHEN v >= 4 THEN ',' || CAST(k % 10 AS VARCHAR) ELSE '' END AS image,
  CAST(0 AS INTEGER) AS n_extra FROM keyed""",
        "job_latest_offsets": job.format(log=CHANGES, name="changes WHERE file <> 'binlog.000001' OR pos > 10000 * (pos % 3 + 1)"),
        "job_counters": f"""WITH {CHANGES}, every AS (
  SELECT op, tbl FROM changes UNION ALL SELECT 'c', 'ev_' || event_type FROM events)
SELECT 'records' AS counter, count(*) AS records FROM every
UNION ALL SELECT 'op_' || o, count(*) FILTER (op = o) FROM every, (VALUES ('r'), ('c'), ('u'), ('d')) AS ops(o) GROUP BY o
UNION ALL SELECT 'schema_changes', count(*) FILTER (op IS NULL) FROM every
UNION ALL SELECT 'fallback', count(*) FILTER (coalesce(tbl, '') = '') FROM every""",
        "job_latest_indexed": job.format(log=HANDOFF, name="later"),
        "snapshot_resumed": f"""WITH {MOVING}, kept AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY stretch DESC, pos DESC) AS rn FROM moving WHERE stretch <= 2 + 2 * chunk),
meanwhile AS (SELECT DISTINCT id FROM moving WHERE stretch IN (3 + 2 * chunk, 4 + 2 * chunk))
SELECT 'test' AS db, 'tb_order' AS tbl, 'r' AS op, CAST(NULL AS BIGINT) AS before_id, after_id, after_status, after_price
FROM kept ANTI JOIN meanwhile USING (id) WHERE rn = 1 AND op <> 'd'
UNION ALL SELECT 'test', 'tb_order', op, before_id, after_id, after_status, after_price FROM moving WHERE stretch > 2 + 2 * chunk""",
        "job_timestamp": job.format(log=CHANGES, name="changes WHERE pos >= 30000"),
        "order_projection": f"""WITH {ORDER_STEPS}
SELECT id, user_id, user_id % 44444 AS inviter_id, goods_id, CAST(floor(goods_id / 100) AS BIGINT) AS goods_cate_id,
  concat('goodsName', CAST(goods_id AS VARCHAR)) AS goods_name, price, amount, total_price, coupon_id, coupon_amount,
  freight_charge, total_price - coupon_amount + freight_charge AS pay_amount, user_id + 30000 AS address_id, status,
  created_time, pay_time, send_out_time, finished_time, updated_time
FROM final""",
        "order_snapshot": f"""WITH {ORDER_STEPS}, exact AS (
  SELECT *, CAST(goods_id AS DECIMAL(14,0)) * CAST(0.001 AS DECIMAL(3,3)) AS price3,
    CAST(goods_id AS DECIMAL(14,0)) * CAST(0.001 AS DECIMAL(3,3)) * CAST(amount AS DECIMAL(4,0)) AS total3,
    strftime(created_time, '%Y%m%d%H%M%S') AS stamp FROM final)
SELECT CAST(id AS INTEGER) AS id, stamp || CAST(id % 90000 + 10000 AS VARCHAR) AS order_no,
  stamp || CAST(id % 9000000 + 1000000 AS VARCHAR) AS third_order_no, CAST(user_id AS INTEGER) AS user_id,
  CAST(user_id % 44444 AS INTEGER) AS inviter_id, CAST(id % 3001 + 1000 AS INTEGER) AS shop_id,
  CAST(goods_id AS INTEGER) AS goods_id, CAST(floor(goods_id / 100) AS INTEGER) AS goods_cate_id,
  'goodsName' || CAST(goods_id AS VARCHAR) AS goods_name, {_cents("price3")} AS price, CAST(amount AS INTEGER) AS amount,
  {_cents("total3")} AS total_price, {_shanghai("created_time")} AS created_time,
  '优惠劵' || CAST(coupon_id AS VARCHAR) AS coupon_name, CAST(id % 4 + 1 AS INTEGER) AS pay_channel,
  CAST(coupon_id AS INTEGER) AS coupon_id, CAST(status AS INTEGER) AS status,
  '用户备注' || CAST(user_id AS VARCHAR) || CAST(id % 9000 + 1000 AS VARCHAR) AS user_remark,
  CAST(freight_charge AS DOUBLE) AS freight_charge,
  {_cents("total3 + CAST(freight_charge AS DECIMAL(6,0)) - CAST(coupon_amount AS DECIMAL(6,0))")} AS pay_amount,
  'P' || CAST(id + 100000000 AS VARCHAR) AS pay_order_no, CAST(user_id + 30000 AS INTEGER) AS address_id,
  {_shanghai("pay_time")} AS pay_time, {_shanghai("updated_time")} AS updated_time,
  {_shanghai("send_out_time")} AS send_out_time, {_shanghai("finished_time")} AS finished_time,
  CAST(coupon_amount AS DOUBLE) AS coupon_amount, CAST(0 AS INTEGER) AS order_month,
  {_shanghai("coalesce(updated_time, created_time)")} AS change_time, '' AS create_date
FROM exact""",
        "replay_state": f"""WITH {CHANGES}, newest AS ({newest.format(log="changes")})
SELECT db, tbl, after_id AS id, after_status AS status, after_price AS price FROM newest WHERE rn = 1 AND op <> 'd'""",
        "replay_mixed_tables": f"""WITH {CHANGES}, newest AS ({newest.format(log="changes")})
SELECT db, tbl, after_id AS id, op, pos FROM newest WHERE rn = 1 AND op <> 'd'
UNION ALL SELECT 'app', 'ev_' || event_type, event_id, 'c', event_id * 100 FROM events""",
        "merge_batches": f"""WITH {CHANGES}, newest AS ({newest.format(log="changes")})
SELECT db, tbl, after_id AS id, after_status AS status, after_price AS price FROM newest WHERE rn = 1 AND op <> 'd'""",
        "last_change_per_row": f"""WITH {CHANGES}, newest AS ({newest.format(log="changes")})
SELECT db, tbl, coalesce(after_id, before_id) AS id, op FROM newest WHERE rn = 1""",
    }
    # The same rows from a log that is kept parsed.
    same = {"route": "routed_counts", "filter": "filter_tables", "replay": "replay_mixed_tables", "state": "replay_state"}
    return found | {f"parsed_log_{name}": found[of] for name, of in same.items()}
