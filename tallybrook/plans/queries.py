"""One query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import columns as C
from tallybrook.operators import display, positions, pricing, publish
from tallybrook.operators import metrics as M
from tallybrook.operators.decode import REJECTED, decode_with_rejects, envelope, parse
from tallybrook.operators.enrich import enrich, lake_rows
from tallybrook.operators.rejects import beyond_repair, replay
from tallybrook.operators.rejects import reject_reasons as reasons_of
from tallybrook.operators.repeats import unique_events
from tallybrook.plans.workspace import fresh_folder
from tallybrook.schemas import CLICK, KINDS, ORDER, PAYMENT, PARTITION_FIELDS, EventKind
from tallybrook.sources import tables
from tallybrook.sources.lake import read_lake, settle
from tallybrook.sources.messages import batch_messages, stream_messages
from tallybrook.streaming import ingest, live, progress
from tallybrook.streaming import publish as publishing

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

ALL_AT_ONCE = {"availableNow": True}
HOUR = 3600

# A backfill may take a terabyte at a time and resume in between.
BOUNDED = {"maxBytesPerTrigger": str(1 << 40)}

# Streams get their messages in parts, and are started anew for each: so what they carry from
# one batch to the next, and over a restart, is in their results.
PARTS = 4
# Seconds at which the parts of the live series begin and end, and when it is read.
SPANS = ((0.0, 2.0), (3.0, 12.0), (30.0, 31.0), (31.5, 33.0))
READ_AT = 40.0

# The range of the pruned read.
PRUNED_DAYS = ("2024-01-08", "2024-01-14")
PRUNED_HOURS = (9, 17)


def query(build: Query) -> Query:
    """Register under the function's name; event times are read as UTC."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            # Plans keep the zone that they were made with.
            return build(spark, sf_dir)
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    REGISTRY[build.__name__] = run
    return run


def _plain_time(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _day_text(name: str = "date") -> Column:
    """Days as text: engines hand dates over as different types."""
    return F.col(name).cast("string").alias(name)


def _revenue(amount: str) -> Column:
    return F.sum(C.money(F.col(amount))).cast("double").alias("revenue")


def _batch_lake_rows(spark: SparkSession, sf_dir: str, kind: EventKind) -> DataFrame:
    return lake_rows(tables.messages(spark, sf_dir, kind), kind)


def _tier_totals(orders: DataFrame) -> DataFrame:
    counted = orders.groupBy("price_tier").agg(
        F.count(F.lit(1)).alias("orders"), _revenue("total_amount")
    )
    return counted.orderBy("price_tier")


# Messages


@query
def envelope_topic_counts(spark, sf_dir):
    arrived = tables.messages(spark, sf_dir)
    return arrived.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query
def publish_frame(spark, sf_dir):
    """Messages per key and topic."""
    frame = publish.publish_frame(tables.event_rows(tables.read_events(spark, sf_dir)))
    return frame.groupBy("key", "topic").agg(F.count(F.lit(1)).alias("n"))


@query
def publish_payloads(spark, sf_dir):
    """Published JSON read back: every field of every kind, NULLs included."""
    arrived = tables.messages(spark, sf_dir)
    fields = {**ORDER.fields, **CLICK.fields, **PAYMENT.fields}
    filled = [F.count(name).alias(name) for name in fields if name != "event_type"]
    return parse(arrived, fields, "topic").groupBy("event_type", "topic").agg(*filled)


@query
def payload_routing(spark, sf_dir):
    """By payload type whatever the topic; types nobody knows add nothing.

    Sign-ups travel here as a type of their own.
    """
    arrived = tables.messages(spark, sf_dir)
    renamed = F.regexp_replace(
        "raw_json", '"event_type":"payment"(.*"status":"success")', '"event_type":"signup"$1'
    )
    return M.kpi_totals(M.facts(arrived.withColumn("raw_json", renamed)))


@query
def throughput(spark, sf_dir):
    return M.throughput(tables.messages(spark, sf_dir))


# Lake rows


def _comparable(rows: DataFrame) -> DataFrame:
    """Lake rows without the two times of the run, and times without a zone."""
    settled = rows.drop("ingest_ts", "kafka_timestamp")
    return settled.withColumns({"event_ts": _plain_time("event_ts"), "date": _day_text()})


@query
def orders_enriched(spark, sf_dir):
    return _comparable(_batch_lake_rows(spark, sf_dir, ORDER))


@query
def clicks_enriched(spark, sf_dir):
    return _comparable(_batch_lake_rows(spark, sf_dir, CLICK))


@query
def payments_enriched(spark, sf_dir):
    return _comparable(_batch_lake_rows(spark, sf_dir, PAYMENT))


@query
def orders_by_price_tier(spark, sf_dir):
    return _tier_totals(_batch_lake_rows(spark, sf_dir, ORDER))


@query
def clicks_by_engagement(spark, sf_dir):
    rows = _batch_lake_rows(spark, sf_dir, CLICK)
    return rows.groupBy("engagement").agg(F.count(F.lit(1)).alias("clicks"))


@query
def payments_by_outcome(spark, sf_dir):
    """Both notions of success, and the reason where a payment failed."""
    rows = _batch_lake_rows(spark, sf_dir, PAYMENT)
    keys = ("status", "is_successful", "failure_reason")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("payments"))


@query
def partition_counts(spark, sf_dir):
    """Events of all kinds per lake partition."""
    stamped = parse(tables.messages(spark, sf_dir), {"timestamp": "string"})
    event_ts = C.event_time(F.col("timestamp"))
    placed = stamped.select(F.to_date(event_ts).alias("date"), F.hour(event_ts).alias("hour"))
    counted = placed.groupBy(*PARTITION_FIELDS).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("date", _day_text())


@query
def weekend_activity(spark, sf_dir):
    rows = _batch_lake_rows(spark, sf_dir, ORDER)
    return rows.groupBy("is_weekend").agg(
        F.count(F.lit(1)).alias("orders"), _revenue("total_amount")
    )


@query
def late_event_partitions(spark, sf_dir):
    """Events that arrive up to two days late still land on the day they happened."""
    rows = tables.event_rows(tables.read_events(spark, sf_dir), (ORDER,))
    lag = F.make_interval(hours=(F.col("event_id").cast("long") % 49).cast("int"))
    late = tables.as_messages(rows.withColumn("arrival", F.col("arrival") + lag), (ORDER,))
    landed = lake_rows(late, ORDER)
    arrived_later = F.to_date("kafka_timestamp") > F.col("date")
    counted = landed.groupBy("date").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(arrived_later).alias("late_events")
    )
    return counted.withColumn("date", _day_text())


def _damaged(raw_json: Column, variant: Column) -> Column:
    """Seven ways a message goes wrong; variant 0 and anything else is left alone."""
    quantity = '"quantity":([0-9]+)'
    price = '"unit_price":([0-9.E-]+)'
    changes = [
        F.regexp_replace(raw_json, "}$", ""),
        F.concat(F.lit("["), raw_json, F.lit("]")),
        F.lit(""),
        F.lit(None).cast("string"),
        F.regexp_replace(raw_json, quantity, '"quantity":"$1"'),
        F.regexp_replace(raw_json, price, '"unit_price":"$1"'),
        F.regexp_replace(raw_json, "}$", ',"extra":1}'),
    ]
    result = F.when(variant == 0, raw_json)
    for number, change in enumerate(changes, start=1):
        result = result.when(variant == number, change)
    return result


def _damaged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    sound = tables.messages(spark, sf_dir, ORDER)
    number = F.regexp_extract("raw_json", '"event_id":"([0-9]+)"', 1).cast("long")
    variant = (number % 8).cast("int")
    return sound.select(
        "user_id_key",
        _damaged(F.col("raw_json"), variant).alias("raw_json"),
        "topic",
        # The arrival time carries the variant past decoding.
        F.timestamp_seconds(variant).alias("kafka_timestamp"),
    )


def _variant() -> Column:
    return F.unix_seconds("kafka_timestamp").cast("int").alias("variant")


@query
def bad_records(spark, sf_dir):
    """What is left of damaged messages: the row always, the fields as far as readable."""
    decoded = decode_with_rejects(_damaged_orders(spark, sf_dir), ORDER)
    rows = enrich(decoded, ORDER)
    return rows.groupBy(_variant()).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("event_id").alias("with_event_id"),
        F.count("quantity").alias("with_quantity"),
        F.count("unit_price").alias("with_price"),
        F.count_if(F.col("date").isNull()).alias("without_date"),
        F.count_if(F.col("price_tier") == "premium").alias("premium"),
        F.count_if("is_rejected").alias("rejected"),
        F.count("rejected_json").alias("with_rejected_text"),
    )


def _rejected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects as they are kept: a table of texts and arrival times."""
    rows = decode_with_rejects(_damaged_orders(spark, sf_dir), ORDER).where("is_rejected")
    kept = fresh_folder(spark, "rejects")
    rows.select("kafka_timestamp", REJECTED).write.parquet(kept)
    return spark.read.parquet(kept)


@query
def reject_reasons(spark, sf_dir):
    """Why damaged messages were rejected: the reason, and what each wrong field held instead."""
    told = reasons_of(_rejected_orders(spark, sf_dir), ORDER)
    each = told.select(_variant(), "reason", F.explode_outer("problems").alias("problem"))
    spelled = F.col("problem.text").cast("decimal(20,6)")
    return each.groupBy("variant", "reason", "problem.field", "problem.expected", "problem.found").agg(
        F.count(F.lit(1)).alias("n"), F.sum(spelled).cast("double").alias("total")
    )


@query
def replayed_rejects(spark, sf_dir):
    """Rejects that are mended and decoded again, and those that are not."""
    rejected = _rejected_orders(spark, sf_dir)
    again = lake_rows(replay(rejected, ORDER), ORDER).groupBy(_variant()).agg(
        F.lit("replayed").alias("outcome"),
        F.count(F.lit(1)).alias("n"),
        F.count("date").alias("dated"),
        F.sum("quantity").alias("units"),
        _revenue("total_amount"),
    )
    left = beyond_repair(rejected, ORDER).groupBy(_variant()).agg(
        F.lit("left").alias("outcome"), F.count(F.lit(1)).alias("n")
    )
    return again.unionByName(left, allowMissingColumns=True)


@query
def orders_sent_again(spark, sf_dir):
    """A third of the orders comes a second time, a seventh another time; each counts once."""
    sent = tables.messages(spark, sf_dir, ORDER)
    number = F.regexp_extract("raw_json", '"event_id":"([0-9]+)"', 1).cast("long")
    for every, hours in ((3, 1), (7, 2)):
        repeated = tables.messages(spark, sf_dir, ORDER).where(number % every == 0)
        later = F.col("kafka_timestamp") + F.make_interval(hours=F.lit(hours))
        sent = sent.unionByName(repeated.withColumn("kafka_timestamp", later))
    once = unique_events(lake_rows(sent, ORDER))
    lag = F.unix_seconds("kafka_timestamp") - F.unix_seconds("event_ts")
    return once.groupBy("price_tier").agg(
        F.count(F.lit(1)).alias("orders"),
        _revenue("total_amount"),
        F.sum(lag).alias("lag_seconds"),
    )


# Dashboard


def _facts(spark: SparkSession, sf_dir: str, *kinds: EventKind) -> DataFrame:
    return M.facts(tables.messages(spark, sf_dir, *kinds))


@query
def kpi_totals(spark, sf_dir):
    return M.kpi_totals(_facts(spark, sf_dir))


@query
def orders_by_category(spark, sf_dir):
    counted = M.orders_by_category(_facts(spark, sf_dir, ORDER))
    return M.ranked(counted, F.desc("orders"), "category")


@query
def top_cities_by_revenue(spark, sf_dir):
    top = M.top_cities_by_revenue(_facts(spark, sf_dir, ORDER))
    return M.ranked(top, F.desc("revenue"), "city")


@query
def top_of_many_cities(spark, sf_dir):
    """Ten of forty labels."""
    rows = tables.event_rows(tables.read_events(spark, sf_dir), (ORDER,))
    district = (F.col("event_id").cast("long") % 4).cast("string")
    many = rows.withColumn("city", F.concat("city", F.lit(" "), district))
    top = M.top_cities_by_revenue(M.facts(tables.as_messages(many, (ORDER,))))
    return M.ranked(top, F.desc("revenue"), "city")


def _odd_amounts(rows: DataFrame) -> DataFrame:
    """Amounts of every size: huge ones, parts of a cent, and ones that can't be added up."""
    number = F.col("event_id").cast("long") % 4
    amount = (
        F.when(number == 0, F.lit(5e16)).when(number == 1, F.lit(0.004)).when(number == 2, 1e300)
    )
    return rows.withColumn("total_amount", amount.otherwise(F.col("total_amount")))


@query
def amounts_of_every_size(spark, sf_dir):
    rows = tables.event_rows(tables.read_events(spark, sf_dir), (ORDER,))
    odd = tables.as_messages(_odd_amounts(rows), (ORDER,))
    return M.amount_quality(M.facts(odd))


@query
def orders_by_device(spark, sf_dir):
    return M.orders_by_device(_facts(spark, sf_dir, ORDER))


@query
def payments_by_method(spark, sf_dir):
    counted = M.payments_by_method(_facts(spark, sf_dir, PAYMENT))
    return M.ranked(counted, F.desc("payments"), "payment_method")


@query
def dashboard_breakdowns(spark, sf_dir):
    """All breakdowns in one pass over the events."""
    return M.breakdowns(M.panels(_facts(spark, sf_dir)))


@query
def missing_field_defaults(spark, sf_dir):
    """Breakdowns of events with gaps: a missing label has a name, a missing amount is 0."""
    rows = tables.event_rows(tables.read_events(spark, sf_dir))
    number = F.col("event_id").cast("long")

    def gap(name: str, every: int) -> Column:
        return F.when(number % every != 0, F.col(name))

    gaps = {"category": 3, "city": 4, "device": 5, "payment_method": 6, "total_amount": 7}
    holed = rows.withColumns({name: gap(name, every) for name, every in gaps.items()})
    return M.breakdowns(M.panels(M.facts(tables.as_messages(holed))))


@query
def orders_per_cycle(spark, sf_dir):
    points = M.cycle_points(_facts(spark, sf_dir), HOUR)
    return M.last_cycles(points, HOUR).withColumn("cycle_start", _plain_time("cycle_start"))


@query
def display_kpis(spark, sf_dir):
    return display.kpi_texts(M.kpi_totals(_facts(spark, sf_dir)))


@query
def display_top_cities(spark, sf_dir):
    return display.city_texts(M.top_cities_by_revenue(_facts(spark, sf_dir, ORDER)))


@query
def display_cycles(spark, sf_dir):
    points = M.cycle_points(_facts(spark, sf_dir), HOUR)
    return display.cycle_texts(M.last_cycles(points, HOUR))


# Prices and products


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


@query
def order_pricing(spark, sf_dir):
    items = _line_items(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("product_id"),
        "l_quantity",
        "l_discount",
    )
    products = _parts(spark, sf_dir).select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("unit_price")
    )
    priced = pricing.price_orders(
        pricing.attach_products(items, products), "unit_price", "l_quantity", "l_discount"
    )
    return priced.select(
        "l_orderkey",
        "l_linenumber",
        F.col("subtotal").cast("double").alias("subtotal"),
        F.col("total_amount").cast("double").alias("total"),
    )


@query
def payment_pricing(spark, sf_dir):
    events = tables.read_events(spark, sf_dir)
    payments = events.where(F.col("event_type").isin(*tables.ROW_TYPES[PAYMENT]))
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    counted = payments.select(
        "event_id",
        "value",
        (F.col("event_id") % 3 + 1).alias("units"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        tables.pick(tables.FAILURE_REASONS, k).alias("reason"),
    )
    return pricing.price_payments(counted, "value", "units").select(
        "event_id",
        F.col("amount").cast("double").alias("amount"),
        pricing.failure_reason(F.col("status"), F.col("reason")).alias("failure_reason"),
    )


@query
def catalog_denormalise(spark, sf_dir):
    items = _line_items(spark, sf_dir).select(F.col("l_partkey").alias("product_id"))
    products = _parts(spark, sf_dir).select(F.col("p_partkey").alias("product_id"), "p_brand")
    return pricing.events_per_attribute(items, products, "p_brand")


# Streams: each runs to the end of its input, then reads back what it wrote


def _append_part(
    spark: SparkSession, sf_dir: str, log: str, part: int, parts: int, kinds=KINDS
) -> None:
    events = tables.read_events(spark, sf_dir).where(F.col("event_id") % parts == part)
    rows = tables.event_rows(events, kinds)
    tables.as_raw_messages(rows, kinds).write.mode("append").parquet(log)


def _logged(spark: SparkSession, log: str) -> DataFrame:
    return stream_messages(spark, "parquet", BOUNDED, log)


def _in_parts(spark: SparkSession, sf_dir: str, start, kinds=KINDS, parts: int = PARTS) -> None:
    """After each part of the log start queries and let them take what is new.

    ``start`` gets messages and gives queries; their checkpoints carry on.
    """
    log = fresh_folder(spark, "log")
    for part in range(parts):
        _append_part(spark, sf_dir, log, part, parts, kinds)
        ingest.finish(start(lambda kind=None: _logged(spark, log)))


def _land(spark: SparkSession, sf_dir: str, lake: str, kinds=KINDS, parts: int = 2) -> None:
    checkpoints = fresh_folder(spark, "land-checkpoint")

    def start(messages_of):
        return ingest.land_all(messages_of, lake, checkpoints, kinds=kinds, trigger=ALL_AT_ONCE)

    _in_parts(spark, sf_dir, start, kinds, parts)


@query
def lake_pruned_read(spark, sf_dir):
    """Price tiers of one week's working hours, from the lake's directories alone."""
    lake = fresh_folder(spark, "lake")
    _land(spark, sf_dir, lake, (ORDER,))
    settle(spark, lake, ORDER)
    hours = F.col("hour").between(*PRUNED_HOURS)
    days = F.col("date").between(*[F.lit(day).cast("date") for day in PRUNED_DAYS])
    rows = read_lake(spark, lake, ORDER).where(days & hours)
    return rows.groupBy("price_tier").agg(F.count(F.lit(1)).alias("n"))


@query
def lake_settled_read(spark, sf_dir):
    """Rows per hour of a table that is settled between two parts, with late events after it."""
    lake = fresh_folder(spark, "lake")
    checkpoints = fresh_folder(spark, "land-checkpoint")

    runs = count()

    def start(messages_of):
        if next(runs):
            settle(spark, lake, ORDER)
        return [ingest.land(messages_of(), ORDER, lake, checkpoints, trigger=ALL_AT_ONCE)]

    _in_parts(spark, sf_dir, start, (ORDER,))
    counted = read_lake(spark, lake, ORDER).groupBy(*PARTITION_FIELDS)
    return counted.agg(F.count(F.lit(1)).alias("n")).withColumn("date", _day_text())


def _land_and_settle(spark, sf_dir, parts, between=lambda: None, **options) -> str:
    """Land orders in parts and settle each of them; the lake's folder."""
    lake = fresh_folder(spark, "lake")
    checkpoints = fresh_folder(spark, "land-checkpoint")
    runs = count()

    def start(messages_of):
        if next(runs):
            settle(spark, lake, ORDER, **options)
            between()
        return [ingest.land(messages_of(), ORDER, lake, checkpoints, trigger=ALL_AT_ONCE)]

    _in_parts(spark, sf_dir, start, (ORDER,), parts)
    settle(spark, lake, ORDER, **options)
    return lake


@query
def lake_levels(spark, sf_dir):
    """Rows per hour after four settlings, merged by twos, without the settled live files."""
    lake = _land_and_settle(spark, sf_dir, 4, fanout=2, drop_live=True)
    counted = read_lake(spark, lake, ORDER).groupBy(*PARTITION_FIELDS)
    return counted.agg(F.count(F.lit(1)).alias("n")).withColumn("date", _day_text())


@query
def lake_arrivals(spark, sf_dir):
    """Rows per day of what arrived after the first part, from the files that hold it."""
    times = []
    lake = _land_and_settle(
        spark, sf_dir, 2, between=lambda: times.append(datetime.now(timezone.utc))
    )
    later = read_lake(spark, lake, ORDER, arrived_from=times[0]).groupBy(_day_text())
    return later.agg(F.count(F.lit(1)).alias("n"))


@query
def stream_ingest_orders(spark, sf_dir):
    lake = fresh_folder(spark, "lake")
    _land(spark, sf_dir, lake, (ORDER,))
    return _tier_totals(read_lake(spark, lake, ORDER))


@query
def stream_progress(spark, sf_dir):
    """What the landing query reported, one run after the other: each in a row of its own."""
    path, lake = fresh_folder(spark, "progress"), fresh_folder(spark, "lake")
    with progress.recorded(spark, path):
        _land(spark, sf_dir, lake, (ORDER,), PARTS)
    told = progress.runs(progress.read_progress(spark, path))
    batch = progress.read_progress(spark, path).where("`rows` > 0").select("run_id", "batch_id")
    return told.join(batch, "run_id").select(
        "batch_id",
        "batches",
        "rows",
        (F.col("ended_at") >= F.col("started_at")).alias("ended"),
        F.col("error").isNotNull().alias("failed"),
    )


@query
def stream_ingest_stamps(spark, sf_dir):
    """Every landed row is stamped with a time of the run."""
    lake, began = fresh_folder(spark, "lake"), datetime.now(timezone.utc)
    _land(spark, sf_dir, lake, (PAYMENT,))
    inside = F.col("ingest_ts").between(F.lit(began), F.lit(datetime.now(timezone.utc)))
    return read_lake(spark, lake, PAYMENT).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("stamped")
    )


@query
def stream_ingest_all(spark, sf_dir):
    """Three queries side by side; rows per table and partition."""
    lake = fresh_folder(spark, "lake")
    _land(spark, sf_dir, lake, parts=PARTS)
    counts = [
        read_lake(spark, lake, kind)
        .groupBy(*PARTITION_FIELDS)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(kind.table).alias("table_name"), _day_text(), "hour", "n")
        for kind in KINDS
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def lake_kpi_totals(spark, sf_dir):
    """The totals from the lake tables, without parsing a message again."""
    lake = fresh_folder(spark, "lake")
    _land(spark, sf_dir, lake)
    return M.kpi_totals(M.lake_facts(*[read_lake(spark, lake, kind) for kind in KINDS]))


def _holed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a log with four partitions a topic, without some, and with some twice."""
    sound = tables.messages(spark, sf_dir)
    number = F.regexp_extract("raw_json", '"event_id":"([0-9]+)"', 1).cast("long")
    placed = sound.select(
        F.col("user_id_key").cast("binary").alias("key"),
        F.col("raw_json").cast("binary").alias("value"),
        "topic",
        F.col("kafka_timestamp").alias("timestamp"),
        (number % 4).cast("int").alias("partition"),
        F.floor(number / 4).alias("offset"),
    )
    left = placed.where("offset % 50 > 2 AND offset NOT BETWEEN 300 AND 700")
    log = fresh_folder(spark, "log")
    left.unionByName(left.where("offset % 7 = 0")).write.parquet(log)
    return batch_messages(spark, "parquet", path=log, positions=True)


@query
def offset_gaps(spark, sf_dir):
    return positions.offset_gaps(_holed_log(spark, sf_dir))


@query
def offset_coverage(spark, sf_dir):
    return positions.offset_coverage(_holed_log(spark, sf_dir))


@query
def stream_rejects(spark, sf_dir):
    """The texts of damaged messages, kept by a stream of their own."""
    sound = tables.messages(spark, sf_dir, ORDER)
    number = F.regexp_extract("raw_json", '"event_id":"([0-9]+)"', 1).cast("long")
    damaged = sound.select(
        F.col("user_id_key").cast("binary").alias("key"),
        _damaged(F.col("raw_json"), (number % 8).cast("int")).cast("binary").alias("value"),
        "topic",
        F.col("kafka_timestamp").alias("timestamp"),
    )
    log, rejects = fresh_folder(spark, "log"), fresh_folder(spark, "rejects")
    damaged.write.parquet(log)
    checkpoints = fresh_folder(spark, "reject-checkpoint")
    ingest.finish(
        [ingest.quarantine(_logged(spark, log), ORDER, rejects, checkpoints, trigger=ALL_AT_ONCE)]
    )
    kept = spark.read.parquet(f"{rejects}/{ORDER.table}")
    return kept.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count(REJECTED).alias("with_text")
    )


def _publish(spark: SparkSession, rows: DataFrame, log: str):
    """A streamed publish job whose sink is a message log of files."""
    return publishing.start_publishing(
        rows,
        "parquet",
        {"path": log},
        fresh_folder(spark, "publish-checkpoint"),
        F.col("arrival").alias("timestamp"),
        trigger=ALL_AT_ONCE,
    )


@query
def publish_then_ingest(spark, sf_dir):
    """Publish as a stream to a message log, then read the log and land the orders."""
    log, lake = fresh_folder(spark, "log"), fresh_folder(spark, "lake")
    rows = tables.event_rows(tables.stream_events(spark, sf_dir, **BOUNDED))
    ingest.finish([_publish(spark, rows, log)])
    sent = spark.readStream.schema("key string, value string, topic string, timestamp timestamp")
    checkpoints = fresh_folder(spark, "land-checkpoint")
    arriving = envelope(sent.options(**BOUNDED).parquet(log))
    ingest.finish([ingest.land(arriving, ORDER, lake, checkpoints, trigger=ALL_AT_ONCE)])
    return _tier_totals(read_lake(spark, lake, ORDER))


@query
def publish_rejects(spark, sf_dir):
    """Events of unknown types and of none stop nothing: sent per topic, and kept apart."""
    rows = tables.event_rows(tables.stream_events(spark, sf_dir, **BOUNDED))
    number = F.col("event_id").cast("long")
    event_type = F.when(number % 5 == 0, "refund").when(number % 7 != 0, F.col("event_type"))
    odd = rows.withColumn("event_type", event_type)
    log, kept = fresh_folder(spark, "log"), fresh_folder(spark, "kept")
    checkpoint = fresh_folder(spark, "reject-checkpoint")
    ingest.finish(
        [
            _publish(spark, odd, log),
            publishing.start_rejecting(odd, kept, checkpoint, ALL_AT_ONCE),
        ]
    )
    sent = spark.read.parquet(log).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    left = spark.read.parquet(kept).agg(F.count(F.lit(1)).alias("n"))
    return sent.unionByName(left.select(F.lit("rejected").alias("topic"), "n"))


class _Clock:
    """Gives the times of ``SPANS`` one after the other."""

    def __init__(self) -> None:
        self.times = iter([at for span in SPANS for at in span])

    def __call__(self) -> float:
        return next(self.times)


def _run_live(spark: SparkSession, sf_dir: str, clock=time.time) -> str:
    path, checkpoint = fresh_folder(spark, "live"), fresh_folder(spark, "live-checkpoint")

    def start(messages_of):
        return [live.start_live(messages_of(), path, checkpoint, ALL_AT_ONCE, clock)]

    _in_parts(spark, sf_dir, start)
    return path


@query
def stream_kpi_totals(spark, sf_dir):
    return M.kpi_totals(M.totals_of(live.read_totals(spark, _run_live(spark, sf_dir))))


@query
def stream_breakdowns(spark, sf_dir):
    return M.breakdowns(live.read_totals(spark, _run_live(spark, sf_dir)))


@query
def stream_cycles(spark, sf_dir):
    """Orders and revenue of each micro-batch."""
    rows = live.read_cycles(spark, _run_live(spark, sf_dir))
    return rows.select("batch_id", "orders", "revenue")


@query
def stream_cycle_series(spark, sf_dir):
    """A point for each batch however long it took, zeros while nothing arrived until READ_AT."""
    path = _run_live(spark, sf_dir, _Clock())
    series = live.cycle_series(spark, path, READ_AT)
    return series.withColumn("cycle_at", _plain_time("cycle_at"))


@query
def stream_orders_per_cycle(spark, sf_dir):
    """All hours of event time; every part brings events of all of them."""
    path, checkpoint = fresh_folder(spark, "series"), fresh_folder(spark, "series-checkpoint")

    def start(messages_of):
        return [live.start_event_time_cycles(messages_of(), path, checkpoint, HOUR, ALL_AT_ONCE)]

    _in_parts(spark, sf_dir, start)
    points = live.read_event_time_cycles(spark, path)
    return points.withColumn("cycle_start", _plain_time("cycle_start"))
