"""Continuous ingestion of events into a stream table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import append_new, write_stream
from ..operators.state import with_legacy_fields


def _start(rows: DataFrame, sink, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def ingest_stream(rows: DataFrame, out: str, checkpoint: str, *, available_now: bool = True,
                  same_day: bool = False) -> StreamingQuery:
    """Append parsed events (see ``stream_ndjson``), one row per id.

    Each micro-batch is reduced to one row per id and inserted where the table has
    no such id.  No event is too late, and a repeated batch adds nothing, so a
    restart after a lost executor or driver is safe.
    """

    def sink(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # parsed once, though read for its days, its keys and its rows
        try:
            if not batch.isEmpty():
                append_new(batch, out, same_day=same_day)
        finally:
            batch.unpersist()

    return _start(rows, sink, checkpoint, available_now)


def ingest_dual(rows: DataFrame, old: str, new: str, checkpoint: str, *, available_now: bool = True,
                same_day: bool = False) -> StreamingQuery:
    """Write events to both generations.

    The old table is append-only; its part of a repeated batch replaces itself, as
    it is one folder per batch.  The new one is inserted into by id.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        events = with_legacy_fields(batch).persist()
        try:
            if not events.isEmpty():
                write_stream(events, f"{old}/batch={batch_id:012d}", mode="overwrite")
                append_new(events, new, same_day=same_day)
        finally:
            events.unpersist()

    return _start(rows, sink, checkpoint, available_now)
