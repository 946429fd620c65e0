"""From typed event rows to keyed JSON messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.schemas import KINDS, EventKind

NO_USER = "unknown"


def payload_json(events: DataFrame, kind: EventKind) -> Column:
    """The fields of a kind as one JSON object; NULL fields are written as null.

    Fields the table has no column for are NULL.
    """
    fields = [
        F.col(name) if name in events.columns else F.lit(None).cast(dtype).alias(name)
        for name, dtype in kind.fields.items()
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _by_kind(event_type: Column, kinds: tuple[EventKind, ...], result) -> Column:
    first, *rest = kinds
    return reduce(
        lambda built, kind: built.when(event_type == kind.name, result(kind)),
        rest,
        F.when(event_type == first.name, result(first)),
    )


def publishable(events: DataFrame, kinds: tuple[EventKind, ...] = KINDS) -> Column:
    """Events of a known kind; only those have a topic to go to."""
    names = [kind.name for kind in kinds]
    return F.coalesce(F.col("event_type").isin(*names), F.lit(False))


def publish_frame(
    events: DataFrame, *carry: str, kinds: tuple[EventKind, ...] = KINDS
) -> DataFrame:
    """Key, value and topic of every event of a known kind in a table of mixed kinds.

    Each event is written with the fields of its own kind, and keyed by user, so that one
    user's events keep their order. Other events are left to ``unpublishable``: a message
    without a topic would end the whole job.
    """
    event_type = F.col("event_type")
    return events.where(publishable(events, kinds)).select(
        F.coalesce("user_id", F.lit(NO_USER)).alias("key"),
        _by_kind(event_type, kinds, lambda kind: payload_json(events, kind)).alias("value"),
        _by_kind(event_type, kinds, lambda kind: F.lit(kind.topic)).alias("topic"),
        *carry,
    )


def unpublishable(
    events: DataFrame, kinds: tuple[EventKind, ...] = KINDS
) -> DataFrame:
    """The events that ``publish_frame`` leaves out, whole."""
    return events.where(~publishable(events, kinds))
