"""Dashboard numbers, as sums over additive facts.

``facts`` turns messages into one row per event with additive measures; ``panels`` adds them up
per label of each dimension. Every metric below is a sum over either of them, so a metric can
run on the events themselves (batch) or on the panels that a stream keeps current, and several
metrics can share one pass over the events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.functions import columns as C
from tallybrook.operators.decode import parse
from tallybrook.schemas import CLICK, ORDER, PAYMENT

# The only payload fields the numbers need.
FACT_FIELDS = {
    "event_type": "string",
    "timestamp": "string",
    "total_amount": "double",
    "category": "string",
    "city": "string",
    "device": "string",
    "payment_method": "string",
    "status": "string",
}

DIMENSIONS = ("category", "city", "device", "payment_method")
COUNTS = ("orders", "clicks", "payments", "failed", "unusable")
TOTAL = "total"
HISTORY = 60
TOP_CITIES = 10

PANELS_DDL = (
    "panel string, label string, "
    + "".join(f"{name} bigint, " for name in COUNTS)
    + f"revenue {C.MONEY_SUM}"
)


def facts(messages: DataFrame) -> DataFrame:
    """One row per message: its dimensions, and what it adds to each measure.

    The payload's own ``event_type`` decides, not the topic; a message of no known type adds
    nothing. No row is filtered out: Spark would move a filter on a payload field below the
    parser's projection, and parse every message twice.
    """
    parsed = parse(messages, FACT_FIELDS)
    return _measure(parsed.withColumn("event_ts", C.event_time(F.col("timestamp"))))


def lake_facts(*lake_tables: DataFrame) -> DataFrame:
    """The same facts from rows of the lake tables: narrow column reads, nothing to parse.

    Filter the tables by ``date`` and ``hour`` first to read those directories only.
    """
    needed = {name: dtype for name, dtype in FACT_FIELDS.items() if name != "timestamp"}
    times = ("event_ts", "kafka_timestamp")

    def narrowed(table: DataFrame) -> DataFrame:
        fields = [
            F.col(name) if name in table.columns else F.lit(None).cast(dtype).alias(name)
            for name, dtype in needed.items()
        ]
        return table.select(*fields, *times)

    return _measure(reduce(DataFrame.unionByName, map(narrowed, lake_tables)))


def _measure(events: DataFrame) -> DataFrame:
    """Dimensions a kind has no metric for become NULL, which keeps the panels small."""
    is_order, is_click, is_payment = (
        F.col("event_type").eqNullSafe(kind.name) for kind in (ORDER, CLICK, PAYMENT)
    )
    failed = is_payment & F.col("status").eqNullSafe("failed")
    method = F.coalesce("payment_method", F.lit(C.OTHER_METHOD))
    return events.select(
        *[
            F.when(is_order, C.or_unknown(F.col(name))).alias(name)
            for name in ("category", "city", "device")
        ],
        F.when(is_payment, method).alias("payment_method"),
        is_order.cast("long").alias("orders"),
        is_click.cast("long").alias("clicks"),
        is_payment.cast("long").alias("payments"),
        failed.cast("long").alias("failed"),
        (is_order & C.unusable_amount(F.col("total_amount"))).cast("long").alias("unusable"),
        F.when(is_order, C.money(F.col("total_amount")))
        .otherwise(F.lit(0).cast(C.MONEY))
        .alias("revenue"),
        "event_ts",
        "kafka_timestamp",
    )


def _total(measure: str, dtype: str = "long") -> Column:
    """Sum of a measure, zero over no rows at all."""
    return F.coalesce(F.sum(measure), F.lit(0)).cast(dtype)


def _sums() -> list[Column]:
    counts = [F.sum(name).alias(name) for name in COUNTS]
    return [*counts, F.sum("revenue").cast(C.MONEY_SUM).alias("revenue")]


def add_up(parts: DataFrame) -> DataFrame:
    """One row per panel and label from several such rows."""
    return parts.groupBy("panel", "label").agg(*_sums())


def panels(measured: DataFrame) -> DataFrame:
    """All that a dashboard shows: measures per label of each dimension, and in total.

    One row per label, whichever labels occur together, and one of panel ``total``, always.
    Rows are fanned out before they are added up in each task. What has no label is left out
    after adding up: a filter before would move below the parser.
    """
    whole = F.struct(F.lit(TOTAL).alias("panel"), F.lit(None).cast("string").alias("label"))
    each = [F.struct(F.lit(d).alias("panel"), F.col(d).alias("label")) for d in DIMENSIONS]
    fanned = measured.select(F.explode(F.array(whole, *each)).alias("at"), *COUNTS, "revenue")
    labelled = fanned.select("at.panel", "at.label", *COUNTS, "revenue")
    return add_up(labelled).where(F.col("label").isNotNull() | (F.col("panel") == TOTAL))


def totals_of(summed: DataFrame) -> DataFrame:
    """The one row of all events, for ``kpi_totals`` and ``cycle_total``."""
    return summed.where(F.col("panel") == TOTAL)


def labels_of(summed: DataFrame, dimension: str) -> DataFrame:
    """The rows of one dimension, for the breakdowns by it."""
    rows = summed.where(F.col("panel") == dimension)
    return rows.withColumnRenamed("label", dimension).drop("panel")


def kpi_totals(measured: DataFrame) -> DataFrame:
    """One row: orders, clicks, payments, revenue, failures, payment success rate."""
    totals = measured.agg(
        _total("orders").alias("total_orders"),
        _total("clicks").alias("total_clicks"),
        _total("payments").alias("total_payments"),
        _total("revenue", "double").alias("total_revenue"),
        _total("failed").alias("failed_payments"),
    )
    rate = C.success_rate(F.col("failed_payments"), F.col("total_payments"))
    return totals.withColumn("payment_success_rate", rate)


def _counted_by(measured: DataFrame, dimension: str, measure: str) -> DataFrame:
    """Sum of a count per value of a dimension; messages it does not count form no group."""
    counted = measured.groupBy(dimension).agg(F.sum(measure).alias(measure))
    return counted.where(F.col(measure) > 0)


def orders_by_category(measured: DataFrame) -> DataFrame:
    """Busiest category first; equal counts in name order."""
    counted = _counted_by(measured, "category", "orders")
    return counted.orderBy(F.desc("orders"), "category")


def orders_by_device(measured: DataFrame) -> DataFrame:
    return _counted_by(measured, "device", "orders")


def payments_by_method(measured: DataFrame) -> DataFrame:
    """Most used method first; equal counts in name order."""
    counted = _counted_by(measured, "payment_method", "payments")
    return counted.orderBy(F.desc("payments"), "payment_method")


def revenue_by_city(measured: DataFrame) -> DataFrame:
    sums = measured.groupBy("city").agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")
    )
    return sums.where(F.col("orders") > 0).drop("orders")


def top_cities_by_revenue(measured: DataFrame, n: int = TOP_CITIES) -> DataFrame:
    """The n cities with most revenue; equal revenue in name order."""
    ranked = revenue_by_city(measured).orderBy(F.desc("revenue"), "city").limit(n)
    return ranked.withColumn("revenue", F.col("revenue").cast("double"))


def breakdowns(summed: DataFrame) -> DataFrame:
    """All breakdowns at once: panel, label, events, revenue."""
    counted = (F.col("orders") + F.col("payments")).alias("events")
    shown = summed.where(F.col("panel") != TOTAL)
    return shown.select(
        "panel", "label", counted, F.col("revenue").cast("double").alias("revenue")
    )


def amount_quality(measured: DataFrame) -> DataFrame:
    """Orders, their revenue, and how many had an amount that can't be added up."""
    return measured.agg(
        _total("orders").alias("orders"),
        _total("revenue", "double").alias("revenue"),
        _total("unusable").alias("unusable_amounts"),
    )


def ranked(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Adds ``rank``, from 1: the order of a short list as a column."""
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def cycle_total(measured: DataFrame) -> DataFrame:
    """Orders and revenue of one cycle's events, zero for a cycle without orders."""
    return measured.agg(
        _total("orders").alias("orders"), _total("revenue", C.MONEY_SUM).alias("revenue")
    )


def cycle_points(measured: DataFrame, seconds: int, at: str = "kafka_timestamp") -> DataFrame:
    """Orders and revenue per cycle of time; a cycle exists once any message falls in it.

    Cycles of arrival by default: one wrong clock among the senders can't move them. By
    ``event_ts`` a series may end with an event of the far future.

    Per cycle, not per minute. Messages without a time belong to none. They are left out
    after counting: ``window`` would filter on the time before, and so parse twice.
    """
    start = C.cycle_start(F.col(at), seconds).alias("cycle_start")
    sums = measured.groupBy(start).agg(
        F.count(at).alias("timed"),
        F.sum("orders").alias("orders"),
        F.sum("revenue").cast(C.MONEY_SUM).alias("revenue"),
    )
    return sums.where(F.col("timed") > 0).drop("timed")


def last_cycles(points: DataFrame, seconds: int, n: int = HISTORY) -> DataFrame:
    """The last n cycles up to the latest point, in order, zero where nothing happened.

    Only the n latest points are gathered, so the group that fills the gaps stays bounded
    by n whatever the history; the points are computed once.
    """
    step = F.make_interval(secs=F.lit(seconds))
    latest = points.orderBy(F.desc("cycle_start")).limit(n)
    found = latest.agg(
        F.min("cycle_start").alias("oldest"),
        F.max("cycle_start").alias("newest"),
        F.map_from_entries(
            F.collect_list(F.struct("cycle_start", F.struct("orders", "revenue")))
        ).alias("points"),
    ).where(F.col("newest").isNotNull())
    start = F.greatest("oldest", F.col("newest") - step * F.lit(n - 1))
    filled = found.select(
        F.explode(F.sequence(start, F.col("newest"), step)).alias("cycle_start"), "points"
    )
    here = F.col("points")[F.col("cycle_start")]
    return filled.select(
        "cycle_start",
        F.coalesce(here["orders"], F.lit(0).cast("long")).alias("orders"),
        F.coalesce(here["revenue"].cast("double"), F.lit(0.0)).alias("revenue"),
    ).orderBy("cycle_start")


def throughput(messages: DataFrame) -> DataFrame:
    """Messages, seconds between the first and last arrival, and messages per second."""
    arrival = F.unix_micros("kafka_timestamp")
    spans = messages.agg(
        F.count(F.lit(1)).alias("events"),
        ((F.max(arrival) - F.min(arrival)) / F.lit(1e6)).alias("seconds"),
    )
    return spans.withColumn("rate", F.try_divide(F.col("events"), F.col("seconds")))
