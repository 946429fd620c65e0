"""Derived columns of the lake tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import columns as C
from tallybrook.operators.decode import decode
from tallybrook.schemas import EventKind


def _own_column(kind: EventKind) -> dict[str, Column]:
    rules = {
        "price_tier": lambda: C.price_tier(F.col("unit_price")),
        "engagement": lambda: C.engagement(F.col("time_on_page")),
        "is_successful": lambda: C.is_successful(F.col("status")),
    }
    return {name: rules[name]() for name in kind.derived}


def enrich(decoded: DataFrame, kind: EventKind) -> DataFrame:
    """Event and ingest time, calendar buckets, and the column of the kind.

    An event whose time is unreadable stays, with NULL buckets.
    """
    timed = decoded.withColumns(
        {"event_ts": C.event_time(F.col("timestamp")), "ingest_ts": F.current_timestamp()}
    )
    event_ts = F.col("event_ts")
    return timed.withColumns(
        {
            "date": F.to_date(event_ts),
            "hour": F.hour(event_ts),
            "is_weekend": C.is_weekend(event_ts),
            **_own_column(kind),
        }
    ).drop("timestamp")


def lake_rows(messages: DataFrame, kind: EventKind) -> DataFrame:
    """From messages of any topic to the rows of one lake table. No shuffle."""
    return enrich(decode(messages, kind), kind)
