"""A writer for message systems without a Spark connector.

The client is named ``module:function``. The function takes the writer's options
and returns an object with ``send_batch(topics, partitions, values)``, ``flush()`` and
``close()``; the three lists are as long as an Arrow batch. Each task opens one client,
sends its batches and flushes before it reports success, so a lost task is run again
and its records may be sent twice, never lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import import_module

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)


def _send_all(options: dict, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
    module, function = options["client"].split(":")
    client = getattr(import_module(module), function)(options)
    try:
        for batch in batches:
            client.send_batch(*(batch.column(name).to_pylist() for name in ("topic", "partition", "value")))
        client.flush()
    finally:
        client.close()
    return WriterCommitMessage()


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _send_all(self.options, iterator)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _send_all(self.options, iterator)

    def commit(self, messages: list, batchId: int) -> None:
        pass

    def abort(self, messages: list, batchId: int) -> None:
        pass


class MessageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rowrelay_messages"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _BatchWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(dict(self.options))
