"""Helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: For bytes: A-Z to a-z, all else as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Java and Python pattern of a word: anything between spaces, tabs and line breaks.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Only a local session without that
    setting, as in tests, gets a temporary folder, which is then set for the context.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rowrelay-llm-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def saved(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage.

    A lost executor costs no recomputation of what is written. The files go when the
    driver's JVM ends.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return spark.read.schema(frame.schema).parquet(path)


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; empty for null."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def column(frame: DataFrame, name: str):
    """A column by its exact name, also with dots in it."""
    return frame["`" + name.replace("`", "``") + "`"]


def unused(frame: DataFrame, *stems: str) -> list[str]:
    """Names that no column of the frame has, in any case, one for each stem."""
    taken, names = {c.lower() for c in frame.columns}, []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        names.append(stem)
    return names


def text_digest(text):
    """One hash of a text that keeps null and empty apart."""
    return F.xxhash64(F.coalesce(text, F.lit("\x00null")))
