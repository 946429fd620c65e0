"""Text forms for display, kept apart from the numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(count: Column) -> Column:
    """``1624`` as ``1,624``."""
    return F.format_number(count, 0)


def dollars(amount: Column) -> Column:
    """``1234.5`` as ``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def percent(rate: Column) -> Column:
    """``94.5`` as ``94.5%``."""
    return F.format_string("%.1f%%", rate)


def clock(moment: Column) -> Column:
    return F.date_format(moment, "HH:mm:ss")


def day(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")
