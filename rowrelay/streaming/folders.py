"""The shared folder that holds checkpoints and written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session without the setting uses the machine's temporary folder; on
    a cluster executors would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    system, there = file_system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(there)] if system.exists(there) else []


def put_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a small file, which appears under its name only when it is whole."""
    system, hidden = file_system(spark, f"{folder}/_{name}")
    _, there = file_system(spark, f"{folder}/{name}")
    out = system.create(hidden, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    system.delete(there, False)
    if not system.rename(hidden, there):
        raise OSError(f"{name} can't be written to {folder}")


def session_folder(spark: SparkSession) -> str:
    """A folder of this session alone, which goes when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/rowrelay-{spark.sparkContext.applicationId}-{os.getpid()}"
    system, there = file_system(spark, path)
    system.mkdirs(there)
    system.deleteOnExit(there)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the session's folder and read back: computed once, however often it is used."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
