"""Structured Streaming around a store: catch-up and live runs over one feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from forktide.streaming.store import ForkStore, Handler


def start_feed(
    store: ForkStore,
    feed: DataFrame,
    handler: Handler,
    checkpoint: str,
    source: str = "feed",
    available_now: bool = True,
    interval: str = "1 second",
    mode: str = "auto",
) -> StreamingQuery:
    """Run every micro-batch as one epoch of the store.

    ``mode``: ``final`` for catching up, ``hot`` for the head of the feed, ``auto`` to follow the
    ``is_head`` column. The stream keeps its offsets in ``checkpoint``; a batch that was applied but
    not yet acknowledged is recognised by the store's own progress and skipped.
    """
    apply = {"auto": store.apply, "final": store.apply_final, "hot": store.apply_hot}[mode]

    def epoch(batch: DataFrame, batch_id: int) -> None:
        apply(batch, handler, source, batch_id)

    writer = feed.writeStream.foreachBatch(epoch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_feed(store: ForkStore, feed: DataFrame, handler: Handler, checkpoint: str, **kw) -> None:
    """Process everything that is there and return; errors of a batch are raised here."""
    start_feed(store, feed, handler, checkpoint, available_now=True, **kw).awaitTermination()


def drop_repeated(feed: DataFrame, key: list[str], ts: str, delay: str) -> DataFrame:
    """Optional guard against sources that repeat rows: same key within ``delay`` of event time.

    Needs a timestamp with time zone. It never drops rows for being late, only for being repeated,
    so the key has to tell deliveries apart (height, hash and seq besides the event's own key).
    """
    return feed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)
