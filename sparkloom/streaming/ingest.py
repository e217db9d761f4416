"""Incremental ingest: a stream of records appended to a table, each key once, the first one staying."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyindex import append_new
from ..schemas import KEY


def append_stream(stream: DataFrame, target: str, checkpoint: str, order: list[str], key: tuple[str, ...] = KEY, trigger: dict | None = None) -> StreamingQuery:
    """Appends micro-batches of ``stream`` to the Parquet table ``target``, without the keys that it has; of the target,
    only files that may hold a key of the batch are read.

    A batch that is run again after a failure finds its rows in the target and adds none twice.
    """

    def add(batch: DataFrame, number: int) -> None:
        append_new(batch, target, order, key)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
