"""From messages to lake rows, including messages that are not what they should be."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from support import CLICK_EVENT, ORDER_EVENT, PAYMENT_EVENT, event, messages, raw
from tallybrook.operators.decode import decode, decode_with_rejects, envelope, route
from tallybrook.operators.enrich import lake_rows
from tallybrook.schemas import CLICK, KINDS, ORDER, PAYMENT, ddl

EVENTS = (ORDER_EVENT, CLICK_EVENT, PAYMENT_EVENT)


def test_envelope(spark):
    source = raw(spark, [ORDER_EVENT])
    result = envelope(source)
    assert dict(result.dtypes) == {
        "user_id_key": "string",
        "raw_json": "string",
        "topic": "string",
        "kafka_timestamp": "timestamp",
    }
    row = result.first()
    assert row.user_id_key == "key"
    assert json.loads(row.raw_json) == ORDER_EVENT
    assert row.topic == "ecommerce.orders"


def test_route_by_topic_not_by_payload(spark):
    misfiled = messages(spark, [CLICK_EVENT, ORDER_EVENT], topic="ecommerce.orders")
    assert route(misfiled, ORDER).count() == 2
    assert route(misfiled, CLICK, PAYMENT).count() == 0
    assert lake_rows(misfiled, ORDER).count() == 2


@pytest.mark.parametrize("kind", KINDS, ids=lambda kind: kind.name)
def test_decoded_fields(spark, kind):
    decoded = decode(messages(spark, EVENTS), kind)
    assert decoded.columns == [*kind.fields, "kafka_timestamp"]
    assert [dict(decoded.dtypes)[name] for name in kind.fields] == list(kind.fields.values())
    row = decoded.first().asDict()
    row.pop("kafka_timestamp")
    assert row == event(kind.name)
    assert decoded.count() == 1


@pytest.mark.parametrize("kind", KINDS, ids=lambda kind: kind.name)
def test_lake_columns(spark, kind):
    rows = lake_rows(messages(spark, EVENTS), kind)
    kept = [name for name in kind.fields if name != "timestamp"]
    derived = ["event_ts", "ingest_ts", "date", "hour", "is_weekend", *kind.derived]
    assert rows.columns == [*kept, "kafka_timestamp", *derived]
    assert dict(rows.dtypes) == kind.lake_fields


def test_lake_values(spark):
    all_messages = messages(spark, EVENTS)
    order = lake_rows(all_messages, ORDER).first()
    assert order.event_ts == datetime(2026, 3, 13, 14, 5, 6, 123456)
    assert (order.date, order.hour, order.is_weekend) == (date(2026, 3, 13), 14, False)
    assert order.price_tier == "premium"
    assert order.ingest_ts is not None
    click = lake_rows(all_messages, CLICK).first()
    assert (click.date, click.hour, click.is_weekend) == (date(2026, 3, 14), 9, True)
    assert click.engagement == "low"
    payment = lake_rows(all_messages, PAYMENT).first()
    assert (payment.date, payment.hour, payment.is_successful) == (date(2026, 3, 13), 23, True)


@pytest.mark.parametrize(
    "text",
    ["not json", json.dumps(ORDER_EVENT)[:-1], f"[{json.dumps(ORDER_EVENT)}]", "", None],
    ids=["text", "truncated", "array", "empty", "null"],
)
def test_unreadable_message_stays_as_nulls(spark, text):
    broken = messages(spark, [text], topic="ecommerce.orders")
    row = lake_rows(broken, ORDER).first()
    assert all(row[name] is None for name in ORDER.fields if name != "timestamp")
    assert row.kafka_timestamp is not None
    assert (row.event_ts, row.date, row.hour, row.is_weekend) == (None, None, None, None)
    assert row.price_tier == "premium"

    rejected = decode_with_rejects(broken, ORDER).first()
    assert rejected.is_rejected
    assert rejected.rejected_json == text


@pytest.mark.parametrize(
    "change",
    [
        '"quantity": 2.0',
        '"quantity": "2"',
        '"quantity": 99999999999',
    ],
)
def test_mismatch_nulls_one_field(spark, change):
    text = json.dumps(ORDER_EVENT).replace('"quantity": 2', change)
    one = messages(spark, [text], topic="ecommerce.orders")
    row = lake_rows(one, ORDER).first()
    assert row.quantity is None
    assert (row.event_id, row.unit_price, row.hour) == ("e1", 95.25, 14)
    flagged = decode_with_rejects(one, ORDER).first()
    assert flagged.is_rejected and flagged.rejected_json == text
    assert flagged.event_id == "e1"


def test_more_mismatches(spark):
    sent = [
        event("order", event_id="price", unit_price="75"),
        event("order", event_id="number", city=7),
        event("order", event_id="extra", extra=1),
        event("order", event_id="time", timestamp="bad"),
        {k: v for k, v in event("order", event_id="missing").items() if k != "unit_price"},
    ]
    rows = {row.event_id: row for row in lake_rows(messages(spark, sent), ORDER).collect()}
    assert rows["price"].unit_price is None and rows["price"].price_tier == "premium"
    assert rows["number"].city == "7"
    assert rows["extra"].hour == 14
    assert rows["time"].date is None and rows["time"].city == "Chicago"
    assert rows["missing"].unit_price is None and rows["missing"].price_tier == "premium"


def test_sound_messages_are_not_rejected(spark):
    for kind in KINDS:
        row = decode_with_rejects(messages(spark, EVENTS), kind).first()
        assert not row.is_rejected and row.rejected_json is None
        assert row.event_id == event(kind.name)["event_id"]


def test_schema_text():
    assert ddl({"a": "int", "b": "string"}) == "`a` int, `b` string"
