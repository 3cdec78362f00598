"""Tables as DataFrames: the input of a snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.operators.filters import include
from rowrelay.options import Options

#: Tables of the database system itself.
SYSTEM_DATABASES = ("information_schema", "mysql", "performance_schema", "sys")


def jdbc_url(opts: Options) -> str:
    return f"jdbc:mysql://{opts.host}:{opts.port}/?connectionTimeZone={opts.timezone}"


def connection_options(opts: Options) -> dict[str, str]:
    """Reader options of every read; the table or the query comes on top."""
    if opts.password is None:
        raise ValueError("a database read needs a password")
    return {
        "url": jdbc_url(opts),
        "user": opts.username,
        "password": opts.password,
        "fetchsize": "10000",
        # Else a DATETIME is read as a point in time and moved to another zone.
        "preferTimestampNTZ": "true",
    }


def jdbc_options(
    opts: Options, table: str, key: str, lower: int, upper: int, partitions: int
) -> dict[str, str]:
    """Reader options that split a table into key ranges read in parallel."""
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {
        **connection_options(opts),
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession, opts: Options, table: str, key: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """A database table read in ``partitions`` key ranges. Needs the database's driver jar."""
    return spark.read.format("jdbc").options(**jdbc_options(opts, table, key, lower, upper, partitions)).load()


def bounds_options(opts: Options, table: str, key: str) -> dict[str, str]:
    """Reader options for the smallest and largest key, found by the database."""
    return {**connection_options(opts), "query": f"SELECT min({key}) AS lower, max({key}) AS upper FROM {table}"}


def key_bounds(spark: SparkSession, opts: Options, table: str, key: str) -> tuple[int, int]:
    """The range to hand to :func:`read_jdbc`; one row comes back."""
    row = spark.read.format("jdbc").options(**bounds_options(opts, table, key)).load().first()
    return int(row[0] or 0), int(row[1] or 0)


def cuts_options(opts: Options, table: str, key: str, partitions: int, share: float = 1.0) -> dict[str, str]:
    """Reader options for the first key of each of ``partitions`` parts with equally many rows.

    The database reads the key's index only, or a random ``share`` of it.
    """
    if partitions < 1 or not 0 < share <= 1:
        raise ValueError("partitions must be at least 1, and share above 0 and at most 1")
    some = f" WHERE RAND() < {share}" if share < 1 else ""
    parts = f"SELECT {key} AS k, NTILE({partitions}) OVER (ORDER BY {key}) AS part FROM {table}{some}"
    return {**connection_options(opts), "query": f"SELECT MIN(k) AS cut FROM ({parts}) AS parts GROUP BY part"}


def key_cuts(spark: SparkSession, opts: Options, table: str, key: str, partitions: int, share: float = 1.0) -> list:
    """The keys to hand to :func:`read_jdbc_ranges`; one row a partition comes back."""
    rows = spark.read.format("jdbc").options(**cuts_options(opts, table, key, partitions, share)).load()
    return sorted(r[0] for r in rows.where("cut IS NOT NULL").collect())


def _literal(value: object) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "''")
    return str(value) if isinstance(value, int) and not isinstance(value, bool) else f"'{text}'"


def range_predicates(key: str, cuts: Sequence) -> list[str]:
    """Conditions that cut a table at keys of any type: each row, also one without a key, meets one."""
    inner = [_literal(c) for c in list(dict.fromkeys(cuts))[1:]]
    if not inner:
        return ["1 = 1"]
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(inner, inner[1:])]
    return [f"{key} < {inner[0]} OR {key} IS NULL", *middle, f"{key} >= {inner[-1]}"]


def read_jdbc_ranges(spark: SparkSession, opts: Options, table: str, key: str, cuts: Sequence) -> DataFrame:
    """A database table read in parts of about equally many rows, also for sparse or text keys."""
    options = connection_options(opts)
    return spark.read.jdbc(options.pop("url"), table, predicates=range_predicates(key, cuts), properties=options)


def catalog_options(opts: Options) -> dict[str, str]:
    """Reader options for the names and declared types of all columns of the database."""
    columns = "table_schema AS `db`, table_name AS `table`, column_name AS `name`, column_type AS `type`"
    return {**connection_options(opts), "query": f"SELECT {columns} FROM information_schema.columns"}


def read_catalog(spark: SparkSession, opts: Options) -> DataFrame:
    return spark.read.format("jdbc").options(**catalog_options(opts)).load()


def declared_types(catalog: DataFrame, opts: Options) -> dict[str, dict[str, str]]:
    """The captured tables, ``db.table``, each with its columns' declared types.

    ``catalog`` has the columns db, table, name and type. The result is as long as the
    captured tables have columns, whatever their number of rows.
    """
    own = catalog.where(~F.lower("db").isin(*SYSTEM_DATABASES))
    found: dict[str, dict[str, str]] = {}
    for row in include(own, opts.databases, opts.tables).orderBy("db", "table", "name").collect():
        found.setdefault(f"{row.db}.{row.table}", {})[row["name"]] = row["type"]
    return found


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")
