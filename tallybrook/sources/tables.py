"""Events, messages and products out of the star-schema tables.

``events`` rows become order, click and payment events with the payload columns of all
three kinds; the values of the fixed lists are picked by the number in ``props``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators import pricing
from tallybrook.operators.decode import envelope
from tallybrook.operators.publish import publish_frame
from tallybrook.schemas import CLICK, KINDS, ORDER, PAYMENT, EventKind

EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

# Which table rows stand for which kind of event.
ROW_TYPES = {
    ORDER: ("purchase",),
    CLICK: ("click", "view"),
    PAYMENT: ("signup", "error"),
}

# The lists event fields are drawn from.
CATEGORIES = ("Electronics", "Sports", "Kitchen", "Home", "Health")
CITIES = (
    "New York",
    "Los Angeles",
    "Chicago",
    "Houston",
    "Phoenix",
    "Philadelphia",
    "San Antonio",
    "San Diego",
    "Dallas",
    "San Jose",
)
DEVICES = ("mobile", "desktop", "tablet")
SYSTEMS = ("iOS", "Android", "Windows", "macOS")
BROWSERS = ("Chrome", "Safari", "Firefox", "Edge")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "apple_pay", "google_pay")
ORDER_STATUSES = ("pending", "confirmed", "processing")
PAGES = ("home", "search", "category", "product", "cart")
FAILURE_REASONS = ("insufficient_funds", "card_expired", "declined")


def pick(values: tuple[str, ...], number: Column) -> Column:
    return F.array(*[F.lit(value) for value in values])[F.pmod(number, F.lit(len(values)))]


def event_rows(events: DataFrame, kinds: Iterable[EventKind] = KINDS) -> DataFrame:
    """Typed events of the given kinds; the row filter reaches the scan."""
    wanted = [row_type for kind in kinds for row_type in ROW_TYPES[kind]]
    kept = events.where(F.col("event_type").isin(*wanted))
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    numbered = kept.withColumns({"k": k, "row_type": F.col("event_type")})

    row_type, event_id, value = F.col("row_type"), F.col("event_id"), F.col("value")
    is_order = row_type.isin(*ROW_TYPES[ORDER])
    is_payment = row_type.isin(*ROW_TYPES[PAYMENT])
    kind_name = F.when(is_order, ORDER.name).when(is_payment, PAYMENT.name)
    status = F.when(is_payment, F.when(row_type == "error", "failed").otherwise("success"))
    off = ((event_id % 31) / 100).cast(pricing.DISCOUNT)
    units = (event_id % 5 + 1).cast("int")
    subtotal = pricing.amount(value, units)

    return numbered.select(
        kind_name.otherwise(CLICK.name).alias("event_type"),
        event_id.cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.concat(F.lit("U"), "user_id").alias("user_id"),
        F.concat(F.lit("S"), "user_id").alias("session_id"),
        F.concat(F.lit("ORD-"), "event_id").alias("order_id"),
        F.concat(F.lit("PAY-"), "event_id").alias("payment_id"),
        F.concat(F.lit("P"), "k").alias("product_id"),
        F.concat(F.lit("Product "), "k").alias("product_name"),
        pick(CATEGORIES, F.col("k")).alias("category"),
        units.alias("quantity"),
        value.alias("unit_price"),
        off.cast("double").alias("discount"),
        subtotal.cast("double").alias("subtotal"),
        pricing.discounted(subtotal, off).cast("double").alias("total_amount"),
        pricing.amount(value, event_id % 3 + 1).cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        status.otherwise(pick(ORDER_STATUSES, F.col("k"))).alias("status"),
        pricing.failure_reason(
            F.when(row_type == "error", "failed"), pick(FAILURE_REASONS, F.col("k"))
        ).alias("failure_reason"),
        pick(PAYMENT_METHODS, F.col("k")).alias("payment_method"),
        pick(CITIES, F.col("k")).alias("city"),
        pick(DEVICES, F.col("k")).alias("device"),
        pick(PAGES, F.col("k")).alias("page"),
        pick(SYSTEMS, F.col("k")).alias("os"),
        pick(BROWSERS, F.col("k")).alias("browser"),
        F.floor(value).cast("int").alias("time_on_page"),
        F.col("ts").cast("timestamp").alias("arrival"),
    )


def as_raw_messages(rows: DataFrame, kinds: tuple[EventKind, ...] = KINDS) -> DataFrame:
    """Published rows as a message log holds them: key, value, topic, timestamp."""
    return publish_frame(rows, "arrival", kinds=kinds).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.col("arrival").alias("timestamp"),
    )


def as_messages(rows: DataFrame, kinds: tuple[EventKind, ...] = KINDS) -> DataFrame:
    """Publish typed rows and read the messages back, without a broker in between."""
    published = publish_frame(rows, "arrival", kinds=kinds)
    return envelope(published.withColumnRenamed("arrival", "timestamp"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """The same rows as a stream of files: a pattern that this one table matches."""
    reader = spark.readStream.schema(EVENTS_DDL).options(**options)
    return reader.parquet(f"{sf_dir}/events[.]parquet")


def messages(spark: SparkSession, sf_dir: str, *kinds: EventKind) -> DataFrame:
    """Messages of the given kinds, of all kinds when none is given."""
    chosen = kinds or KINDS
    return as_messages(event_rows(read_events(spark, sf_dir), chosen), chosen)
