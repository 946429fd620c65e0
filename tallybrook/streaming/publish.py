"""Publishing events as a running job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallybrook.operators.publish import publish_frame, unpublishable

EVERY_SECOND = {"processingTime": "1 second"}


def start_publishing(
    events: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    *carry: str | Column,
    trigger: Mapping[str, object] = EVERY_SECOND,
) -> StreamingQuery:
    """Send every event of a known kind; ``carry`` adds columns that the sink understands."""
    return (
        publish_frame(events, *carry)
        .writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_rejecting(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_SECOND,
) -> StreamingQuery:
    """Keep the events that have no topic to go to."""
    return (
        unpublishable(events)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
