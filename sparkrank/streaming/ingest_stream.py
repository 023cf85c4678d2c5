"""Ingest as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sparkrank.operators.ingest import ingest


def start_ingest(
    stream: DataFrame,
    target: str,
    dim: int,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    raise_on_error: bool = False,
) -> StreamingQuery:
    """Write every micro-batch to the target as the batch of its number.

    A micro-batch that is replayed after a failure overwrites its own batch, so
    each row counts once. Takes all data that is there, then stops.
    """

    def write(rows: DataFrame, number: int) -> None:
        ingest(prepare(rows) if prepare else rows, target, number, dim, raise_on_error)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
