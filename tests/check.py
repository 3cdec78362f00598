"""Compare every registered query with its SQL, value for value.

Run as ``python tests/check.py [folder] [query ...]``. ``CHECK_ZONE`` sets the session
zone; no result depends on it.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# DuckDB type of each Spark type; decimals keep their digits.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def compare(found: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """An empty text when rows, column names and types agree."""
    described = {name: kind for name, kind, *_ in db.execute(f"DESCRIBE {sql}").fetchall()}
    columns = sorted(found.columns)
    if columns != sorted(described):
        return f"columns {columns} against {sorted(described)}"
    types = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    wanted = {c: TYPES.get(types[c], types[c].upper()) for c in columns}
    if wanted != {c: described[c] for c in columns}:
        return f"types {wanted} against {described}"
    expected = db.execute("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({sql})").fetchall()
    ours = Counter(tuple(plain(v) for v in row) for row in found.select(*[f"`{c}`" for c in columns]).collect())
    theirs = Counter(tuple(plain(v) for v in row) for row in expected)
    if ours != theirs:
        extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"rows {sum(ours.values())} against {sum(theirs.values())}; only ours {extra}; only theirs {missing}"
    return ""


def main() -> int:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_ZONE", "UTC"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, failures = connect(folder), entry.oracle_sql(), 0
    queries = entry.queries()
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            frame = queries[name](spark, folder)
            problem = compare(frame, db, sql[name]) if name in sql else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.2f}s {problem}", flush=True)
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
