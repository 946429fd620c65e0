"""Scalar rules shared by the operators. Each takes and returns Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# An event's amount, and sums of them: exact, wide, and without rounding to cents.
MONEY = "decimal(30,9)"
MONEY_SUM = "decimal(38,9)"

# Upper bounds (exclusive) and their labels, then the label above them all.
PRICE_BANDS = ((25, "budget"), (75, "mid"))
TOP_PRICE_BAND = "premium"
DWELL_BANDS = ((10, "bounce"), (60, "low"), (180, "medium"))
TOP_DWELL_BAND = "high"
UNKNOWN = "Unknown"
OTHER_METHOD = "other"

# Spark counts days from Sunday = 1.
WEEKEND_DAYS = (1, 7)


def banded(value: Column, bands: tuple[tuple[int, str], ...], top: str) -> Column:
    """Label of the first band whose bound exceeds the value.

    NULL and NaN are below no bound, so they get the top label.
    """
    first, *rest = bands
    chain = reduce(
        lambda built, band: built.when(value < band[0], band[1]),
        rest,
        F.when(value < first[0], first[1]),
    )
    return chain.otherwise(top)


def price_tier(unit_price: Column) -> Column:
    return banded(unit_price, PRICE_BANDS, TOP_PRICE_BAND)


def engagement(time_on_page: Column) -> Column:
    return banded(time_on_page, DWELL_BANDS, TOP_DWELL_BAND)


def is_successful(status: Column) -> Column:
    """NULL status stays NULL; not the same notion as "not failed" (see success_rate)."""
    return status == "success"


def event_time(text: Column) -> Column:
    """Event time of an ISO string in the session time zone; NULL when unreadable.

    ``to_timestamp`` would raise under ANSI mode, so one bad record would end a stream.
    """
    return F.try_to_timestamp(text)


def is_weekend(event_ts: Column) -> Column:
    return F.dayofweek(event_ts).isin(*WEEKEND_DAYS)


def or_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit(UNKNOWN))


def money(amount: Column) -> Column:
    """An exact amount, so that sums do not depend on arrival order.

    NULL counts as zero. So do NaN, infinity and amounts of 1e21 or more, which
    ``unusable_amount`` tells apart, instead of ending a stream.
    """
    return F.coalesce(amount.try_cast(MONEY), F.lit(0).cast(MONEY))


def unusable_amount(amount: Column) -> Column:
    """There is an amount, but none that ``money`` can add up."""
    return amount.isNotNull() & amount.try_cast(MONEY).isNull()


def success_rate(failed: Column, total: Column) -> Column:
    """Percentage of payments that did not fail, to one decimal; 100.0 without payments.

    Ties go to the even digit: 3 failed of 16 is 81.2.
    """
    return F.bround((F.lit(1) - failed / F.greatest(total, F.lit(1))) * 100, 1)


def cycle_start(moment: Column, seconds: int) -> Column:
    """Start of the cycle the moment falls in, for cycles of fixed length."""
    whole = F.unix_seconds(moment)
    return F.timestamp_seconds(whole - F.pmod(whole, F.lit(seconds)))
