"""Row images read by the columns that their table had where they were written.

Schema-change records carry the whole column list of each table they change. The lists
of a table, in log order, are its timeline; a record meets the one valid at its place by
an as-of join. Statements are not parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowrelay.functions.position import position_order
from rowrelay.functions.record import FAIL_FAST, POSITION_FIELDS

#: A table's records are joined in so many parts; its column lists are repeated for each.
SALTS = 32

_COLUMNS = "array<struct<name: string, position: int, typeName: string>>"
_CHANGES = f"array<struct<type: string, id: string, table: struct<columns: {_COLUMNS}>>>"
_SOURCE = f"source: struct<db: string, table: string, {POSITION_FIELDS}>"


def _place(sequence: Column, pos: Column, row: Column) -> Column:
    """A place in the log as one value that compares in log order; null if the record has none."""
    at = F.struct(sequence.alias("sequence"), pos.alias("pos"), F.coalesce(row, F.lit(0)).alias("row"))
    return F.when(sequence.isNotNull() & pos.isNotNull(), at)


def column_lists(wire: DataFrame) -> DataFrame:
    """``db``, ``table``, ``since``, ``until`` and ``columns``: the timeline of each table in a bounded log.

    Reads ``tableChanges`` of a schema change, or of the JSON text in its
    ``historyRecord``. ``columns`` are names and type names in their order, null after the
    table was dropped; ``until`` is where the next list begins, null for the last.
    Records delivered twice count once. Of two lists at one place the greater counts.
    A table is named by the id ``"db"."table"`` of its change.
    """
    schema = f"struct<{_SOURCE}, tableChanges: {_CHANGES}, historyRecord: string>"
    texts = wire.where(F.col("value").contains("tableChanges")).select(F.inline(F.array(F.from_json("value", schema, FAIL_FAST))))
    inner = F.from_json("historyRecord", f"struct<tableChanges: {_CHANGES}>", FAIL_FAST)["tableChanges"]
    found = texts.select(_place(*position_order()).alias("since"), F.explode(F.coalesce("tableChanges", inner)).alias("change"))
    name = r'^"(.*)"\."(.*)"$'
    ordered = F.array_sort(F.transform("change.table.columns", lambda c: F.struct(c.position.alias("position"), c["name"].alias("name"), c.typeName.alias("type"))))
    columns = F.transform(ordered, lambda c: F.struct(c["name"].alias("name"), c.type.alias("type")))
    lists = found.where("since IS NOT NULL").select(
        F.regexp_extract("change.id", name, 1).alias("db"),
        F.regexp_extract("change.id", name, 2).alias("table"),
        "since",
        F.when(F.upper("change.type") != "DROP", columns).alias("columns"),
    )
    lists = lists.groupBy("db", "table", "since").agg(F.max("columns").alias("columns"))
    following = F.lead("since").over(Window.partitionBy("db", "table").orderBy("since"))
    return lists.withColumn("until", following).select("db", "table", "since", "until", "columns")


def _own(image: Column, columns: Column) -> Column:
    """The image's value of each listed column, as text, in the list's order."""
    values = F.transform(columns, lambda c: F.struct(c["name"].alias("name"), c.type.alias("type"), F.try_element_at(image, c["name"]).alias("value")))
    return F.when(image.isNotNull(), values)


def decode_by_timeline(wire: DataFrame, lists: DataFrame, salts: int = SALTS) -> DataFrame:
    """``db``, ``table``, ``op``, ``file``, ``pos``, ``row``, ``before``, ``after`` and ``extra`` of every record.

    Images are arrays of name, type and value, by the list valid at the record's place; a
    list is valid from the place of its schema change on. A column that an image lacks
    is null. ``extra`` has the names, sorted, that an image has and the list does not:
    a log that lacks a schema change shows there. Without a list (before the first one,
    after a drop, or for a record that has no place) images are null and every name
    is extra. Malformed records fail the job.

    Each table's records are spread over ``salts`` parts of the join, which its few
    lists are repeated for, so a table with a third of all records is no hot key.
    """
    image = "map<string, string>"
    schema = f"struct<before: {image}, after: {image}, {_SOURCE}, op: string>"
    part = F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int")
    records = wire.select(part.alias("_part"), F.inline(F.array(F.from_json("value", schema, FAIL_FAST))))
    records = records.withColumn("_at", _place(*position_order()))
    known = lists.select(F.col("db").alias("_db"), F.col("table").alias("_table"), "since", "until", "columns", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    valid = (F.col("_at") >= F.col("since")) & (F.col("until").isNull() | (F.col("_at") < F.col("until")))
    same = (F.col("source.db") == F.col("_db")) & (F.col("source.table") == F.col("_table")) & (F.col("_part") == F.col("_salt"))
    joined = records.join(known, same & valid, "left")
    names = F.array_union(*[F.coalesce(F.map_keys(i), F.array().cast("array<string>")) for i in ("before", "after")])
    listed = F.coalesce(F.transform("columns", lambda c: c["name"]), F.array().cast("array<string>"))
    return joined.select(
        "source.db",
        "source.table",
        "op",
        "source.file",
        "source.pos",
        "source.row",
        _own(F.col("before"), F.col("columns")).alias("before"),
        _own(F.col("after"), F.col("columns")).alias("after"),
        F.array_sort(F.array_except(names, listed)).alias("extra"),
    )
