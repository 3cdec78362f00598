"""A change log parsed once and kept, for any number of jobs over it.

Parsing JSON is most of the work of a job over record texts. Here each text is parsed
when it arrives; routing fields become columns and row images VARIANT values, whose
fields are found by path without a schema. Jobs read the columns they need: a route reads
no image, a replay of images no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.functions.record import id_number

STORED = (
    "value string, db string, `table` string, op string, row_id decimal(38,0), before_id decimal(38,0), "
    "file string, pos bigint, row int, source_ts_ms bigint, before variant, after variant"
)


def _field(record: Column, path: str, kind: str = "string") -> Column:
    return F.variant_get(record, path, kind)


def _image(record: Column, name: str) -> Column:
    """The image, null also where the record says null."""
    image = _field(record, f"$.{name}", "variant")
    return F.when(~F.is_variant_null(image), image)


def parsed(wire: DataFrame, key_column: str = "id") -> DataFrame:
    """The columns ``STORED`` of each JSON text (column ``value``), parsed once.

    As :func:`rowrelay.functions.record.parse`: malformed or empty text, a record without
    source and a row image without its id fail the job. A name given twice in one object
    does, too.
    """
    if "'" in key_column or "\\" in key_column:
        raise ValueError(f"a key column can't be named {key_column!r} here")
    # A generator, so that filters moved below it don't parse the text again.
    each = wire.select("value", F.inline(F.array(F.struct(F.parse_json("value").alias("_record")))))
    record = F.col("_record")
    images = each.select("value", "_record", _image(record, "before").alias("before"), _image(record, "after").alias("after"))
    source = _field(record, "$.source", "variant")
    none = source.isNull() | F.is_variant_null(source)
    no_source = F.raise_error(F.lit("change record without source"))

    def key(image: str) -> Column:
        text = _field(F.col(image), f"$['{key_column}']")
        return F.when(F.col(image).isNotNull(), id_number(text, key_column))

    return images.select(
        "value",
        F.when(none, no_source.cast("string")).otherwise(_field(record, "$.source.db")).alias("db"),
        _field(record, "$.source.table").alias("table"),
        _field(record, "$.op").alias("op"),
        key("after").alias("row_id"),
        key("before").alias("before_id"),
        _field(record, "$.source.file").alias("file"),
        _field(record, "$.source.pos", "bigint").alias("pos"),
        _field(record, "$.source.row", "int").alias("row"),
        _field(record, "$.source.ts_ms", "bigint").alias("source_ts_ms"),
        "before",
        "after",
    )


class ParsedLog:
    """The parsed log in the folder ``place``, as Parquet; it grows by batches."""

    def __init__(self, spark: SparkSession, place: str, key_column: str = "id"):
        self.spark, self.place, self.key_column = spark, place, key_column

    def add(self, wire: DataFrame, batch: int) -> None:
        """Parse a batch and keep it. A batch given again replaces what it wrote, so a stream may repeat one."""
        parsed(wire, self.key_column).write.mode("overwrite").parquet(f"{self.place}/batch={batch}")

    def records(self) -> DataFrame:
        """All records so far, as ``parse`` gives them with position and old ids."""
        return self.spark.read.schema(STORED).parquet(self.place).drop("batch")

    def changes(self, image: str) -> DataFrame:
        """All records so far as a change frame; ``image`` is the DDL fields of its row images.

        A field that an image lacks is null, one that doesn't fit its type fails the job.
        """
        where = F.struct("db", "table", "file", "pos", "row", F.col("source_ts_ms").alias("ts_ms"))
        typed = [F.variant_get(F.col(c), "$", f"struct<{image}>").alias(c) for c in ("before", "after")]
        return self.records().select(*typed, where.alias("source"), "op")
