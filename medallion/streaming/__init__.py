"""Structured Streaming upkeep of Bronze and Silver.

Every stream uses ``foreachBatch`` so the very same batch functions
(``operators.bronze``, ``operators.silver``) run on each micro-batch. What a batch writes is
published as one version of each table (``medallion.snapshots``), named by the stream's own id
and the batch's, so a replayed batch (after a failure) takes the place of its own output
instead of duplicating it and never that of another stream. ``start_ingest_stream`` chains landing ->
Bronze -> Silver in one stream (recommended); ``start_notified_stream`` does so for the files that
notifications name, without listing any folder; ``start_bronze_stream`` and
``start_silver_stream`` run the two hops as separate streams;
``start_silver_stream_within_watermark`` keeps the ids of a bounded horizon only.
"""

from medallion.streaming.bronze_stream import start_bronze_stream, start_ingest_stream, start_notified_stream
from medallion.streaming.silver_stream import (
    start_silver_stream,
    start_silver_stream_within_watermark,
    upkeep_batch,
)

__all__ = [
    "start_bronze_stream",
    "start_ingest_stream",
    "start_notified_stream",
    "start_silver_stream",
    "start_silver_stream_within_watermark",
    "upkeep_batch",
]


def run_available_now(query_factory) -> None:
    """Start a stream with ``availableNow`` and block until it has caught up."""
    q = query_factory({"availableNow": True})
    q.awaitTermination()
    if q.exception():
        raise q.exception()
