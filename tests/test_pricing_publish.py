"""Prices, product attributes and published messages."""

from __future__ import annotations

import itertools
import json
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from support import BY_KIND, PRODUCTS, event, product_catalog
from tallybrook.operators import pricing as P
from tallybrook.operators.decode import decode, envelope, parse
from tallybrook.operators.publish import publish_frame, unpublishable
from tallybrook.schemas import KINDS, ORDER, ddl
from tallybrook.sources import tables

CENT = Decimal("0.01")


def test_every_price_the_catalogue_can_make(spark):
    prices = [Decimal(price) for *_, price in PRODUCTS]
    offs = [Decimal(n) / 100 for n in range(31)]
    combos = list(itertools.product(prices, range(1, 6), offs))
    rows = [(float(p), q, float(d)) for p, q, d in combos]
    orders = spark.createDataFrame(rows, "unit_price double, quantity int, discount double")
    priced = P.price_orders(orders).collect()
    assert len(priced) == 1550
    for row in priced:
        subtotal = Decimal(str(row.unit_price)) * row.quantity
        total = (subtotal * (1 - Decimal(str(row.discount)))).quantize(CENT, ROUND_HALF_UP)
        assert (row.subtotal, row.total_amount) == (subtotal, total)
        # The accepted deviation from binary rounding is one cent.
        binary = round(round(row.unit_price * row.quantity, 2) * (1 - row.discount), 2)
        assert abs(row.total_amount - Decimal(str(binary))) <= CENT


def test_golden_prices(spark):
    rows = [(129.99, 3, 0.15), (89.99, 2, 0.25)]
    orders = spark.createDataFrame(rows, "unit_price double, quantity int, discount double")
    got = [(float(r.subtotal), float(r.total_amount)) for r in P.price_orders(orders).collect()]
    assert got == [(389.97, 331.47), (179.98, 134.99)]
    payments = spark.createDataFrame([(129.99, 3)], "price double, units int")
    assert float(P.price_payments(payments, "price", "units").first().amount) == 389.97


def test_failure_reason(spark):
    rows = [("failed", "declined"), ("success", "declined"), (None, "declined")]
    frame = spark.createDataFrame(rows, "status string, reason string")
    got = frame.select(P.failure_reason(F.col("status"), F.col("reason"))).collect()
    assert [row[0] for row in got] == ["declined", None, None]


def hot_events(spark):
    """A third of the events on one product, a tenth on none or an unknown one."""
    return spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "P001")
        .when(F.col("id") % 10 == 1, None)
        .when(F.col("id") % 10 == 2, "P999")
        .otherwise(F.format_string("P%03d", F.col("id") % 10 + 1))
        .alias("product_id"),
    )


@pytest.mark.parametrize("broadcast_limit", ["10MB", "-1"])
def test_products_are_attached_whatever_the_join(spark, broadcast_limit):
    events, products = hot_events(spark), product_catalog(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        plain = P.attach_products(events, products)
        assert plain.count() == 3000
        known = {pid: name for pid, name, *_ in PRODUCTS}
        for row in plain.collect():
            assert row.product_name == known.get(row.product_id)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stream_of_events_with_their_products(spark, tmp_path):
    """Streams may join the catalogue too."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    hot_events(spark).write.parquet(source)
    events = spark.readStream.schema("event_id bigint, product_id string").parquet(source)
    joined = P.attach_products(events, product_catalog(spark))
    query = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    expected = P.attach_products(hot_events(spark), product_catalog(spark))
    landed = spark.read.parquet(out).select(*expected.columns)
    assert landed.count() == 3000
    assert landed.exceptAll(expected).count() == 0


def test_events_per_attribute_is_join_then_count(spark):
    events, products = hot_events(spark), product_catalog(spark)
    counted = P.events_per_attribute(events, products, "category")
    joined = P.attach_products(events, products).groupBy("category").agg(
        F.count(F.lit(1)).alias("events")
    )
    assert sorted(map(tuple, counted.collect()), key=str) == sorted(
        map(tuple, joined.collect()), key=str
    )


def typed(spark, kind, *bodies):
    rows = [tuple(body[name] for name in kind.fields) for body in bodies]
    return spark.createDataFrame(rows, ddl(kind.fields))


@pytest.mark.parametrize("kind", KINDS, ids=lambda kind: kind.name)
def test_published_message(spark, kind):
    body = BY_KIND[kind.name]
    row = publish_frame(typed(spark, kind, body)).first()
    assert row.key == body["user_id"]
    assert row.topic == kind.topic
    # NULLs are written, and fields keep their order.
    assert list(json.loads(row.value).items()) == list(body.items())


def test_unknown_types_are_told_apart(spark):
    """A message without a topic would end the whole job."""
    bodies = [event("order"), event("order", event_type="refund"), event("order", event_type=None)]
    mixed = typed(spark, ORDER, *bodies)
    sent, left = publish_frame(mixed), unpublishable(mixed)
    assert [row.topic for row in sent.collect()] == [ORDER.topic]
    assert sorted(str(row.event_type) for row in left.collect()) == ["None", "refund"]
    assert left.columns == mixed.columns


def test_missing_user_is_keyed_unknown(spark):
    row = publish_frame(typed(spark, ORDER, event("order", user_id=None))).first()
    assert row.key == "unknown"
    assert json.loads(row.value)["user_id"] is None


def test_mixed_table_round_trip(spark, sf_dir):
    rows = tables.event_rows(tables.read_events(spark, sf_dir))
    arrived = tables.as_messages(rows)
    for kind in KINDS:
        sent = rows.where(F.col("event_type") == kind.name).select(*kind.fields)
        back = decode(arrived, kind).drop("kafka_timestamp")
        assert sent.count() > 0
        assert sent.exceptAll(back).count() == 0
        assert back.exceptAll(sent).count() == 0


def test_key_survives_the_envelope(spark):
    frame = publish_frame(typed(spark, ORDER, event("order")))
    log = frame.withColumn("timestamp", F.current_timestamp())
    got = parse(envelope(log), {"user_id": "string"}, "user_id_key").first()
    assert got.user_id == got.user_id_key == "U1000"
