"""Rows that came more than once: publishing is at least once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_events(rows: DataFrame, event_id: str = "event_id", arrived: str = "kafka_timestamp") -> DataFrame:
    """One row per event id, the one that arrived first; rows without an id all stay.

    Of rows that arrived at the same time the least one stays, column by column. The lake itself
    is left as it is. Each task first keeps its own least row of an id, so an id that a third of
    all rows share brings one row a task to the shuffle. Filter by date and hour before.
    """
    names = [arrived, *[name for name in rows.columns if name != arrived]]
    # An id of its own for each row without one keeps them apart, and spread over the tasks.
    alone = F.when(F.col(f"`{event_id}`").isNull(), F.monotonically_increasing_id())
    first = F.min(F.struct(*[F.col(f"`{name}`") for name in names])).alias("_first")
    kept = (
        rows.withColumn("_alone", alone).groupBy(F.col(f"`{event_id}`").alias("_id"), "_alone").agg(first)
    )
    return kept.select(*[F.col(f"_first.`{name}`") for name in rows.columns])
