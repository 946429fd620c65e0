"""Final text projections of the dashboard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import text as X


def kpi_texts(totals: DataFrame) -> DataFrame:
    return totals.select(
        X.thousands(F.col("total_orders")).alias("total_orders"),
        X.thousands(F.col("total_clicks")).alias("total_clicks"),
        X.thousands(F.col("total_payments")).alias("total_payments"),
        X.dollars(F.col("total_revenue")).alias("total_revenue"),
        X.percent(F.col("payment_success_rate")).alias("payment_success"),
    )


def city_texts(cities: DataFrame) -> DataFrame:
    return cities.select("city", X.dollars(F.col("revenue")).alias("revenue"))


def cycle_texts(series: DataFrame) -> DataFrame:
    """Series points labelled with day and time of day."""
    return series.select(
        X.day(F.col("cycle_start")).alias("day"),
        X.clock(F.col("cycle_start")).alias("time"),
        "orders",
        "revenue",
    )
