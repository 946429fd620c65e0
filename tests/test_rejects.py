"""Reasons of rejects, mended messages, and messages that came more than once."""

from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from support import ARRIVED, CLICK_EVENT, ORDER_EVENT, PAYMENT_EVENT, event, messages
from tallybrook.operators.decode import REJECTED, decode, decode_with_rejects
from tallybrook.operators.enrich import lake_rows
from tallybrook.operators.rejects import beyond_repair, mend, reject_reasons, replay
from tallybrook.operators.repeats import unique_events
from tallybrook.schemas import CLICK, KINDS, ORDER, PAYMENT


def rejects(spark, texts, kind=ORDER):
    sent = messages(spark, texts, topic=kind.topic)
    return decode_with_rejects(sent, kind).where("is_rejected").select("kafka_timestamp", REJECTED)


def changed(**fields):
    return json.dumps({**ORDER_EVENT, **fields})


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (None, "null"),
        ("", "empty"),
        ("  ", "empty"),
        ("not json", "not json"),
        (json.dumps(ORDER_EVENT)[:-1], "not json"),
        (json.dumps([ORDER_EVENT]), "no object"),
        ("[]", "no object"),
        (changed(quantity="2"), "wrong type"),
    ],
)
def test_reason(spark, text, reason):
    rejected = spark.createDataFrame([(text, 7)], f"{REJECTED} string, reason_of int")
    row = reject_reasons(rejected, ORDER).first()
    assert row.reason == reason and row.reason_of == 7
    assert bool(row.problems) == (reason == "wrong type")


@pytest.mark.parametrize(
    ("field", "value", "expected", "found", "text"),
    [
        ("quantity", "2", "int", "string", "2"),
        ("quantity", 2.5, "int", "number", "2.5"),
        ("quantity", 99999999999, "int", "number", "99999999999"),
        ("quantity", True, "int", "boolean", "true"),
        ("unit_price", [1], "double", "array", "[1]"),
        ("unit_price", {"a": 1}, "double", "object", '{"a":1}'),
    ],
)
def test_problem(spark, field, value, expected, found, text):
    row = reject_reasons(rejects(spark, [changed(**{field: value})]), ORDER).first()
    assert [tuple(p) for p in row.problems] == [(field, expected, found, text)]


def test_several_problems_at_once(spark):
    row = reject_reasons(rejects(spark, [changed(quantity="x", discount="", city=7)]), ORDER).first()
    assert [(p.field, p.text) for p in row.problems] == [("quantity", "x"), ("discount", "")]


def test_sound_messages_are_readable(spark):
    for kind, body in ((ORDER, ORDER_EVENT), (CLICK, CLICK_EVENT), (PAYMENT, PAYMENT_EVENT)):
        sound = spark.createDataFrame([(json.dumps({**body, "extra": None}),)], f"{REJECTED} string")
        row = reject_reasons(sound, kind).first()
        assert (row.reason, row.problems) == ("readable", [])
        again = mend(sound, kind).first().mended_json
        assert json.loads(again) == {k: v for k, v in body.items() if v is not None}


@pytest.mark.parametrize(
    ("text", "quantity", "price"),
    [
        (changed(quantity="3"), 3, 95.25),
        (changed(quantity=" 3 "), 3, 95.25),
        (changed(quantity=3.0), 3, 95.25),
        (changed(quantity="3", unit_price="7.5e1"), 3, 75.0),
        (json.dumps([ORDER_EVENT]), 2, 95.25),
        (json.dumps([{**ORDER_EVENT, "quantity": "4"}]), 4, 95.25),
    ],
)
def test_mended(spark, text, quantity, price):
    again = decode(replay(rejects(spark, [text]), ORDER), ORDER).collect()
    assert [(r.quantity, r.unit_price, r.event_id, r.city) for r in again] == [
        (quantity, price, "e1", "Chicago")
    ]
    sent = replay(rejects(spark, [text]), ORDER).first()
    assert (sent.user_id_key, sent.topic) == ("U1000", ORDER.topic)
    assert sent.kafka_timestamp is not None
    assert not decode_with_rejects(replay(rejects(spark, [text]), ORDER), ORDER).first().is_rejected


@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        "not json",
        "[]",
        "[7]",
        json.dumps([ORDER_EVENT, ORDER_EVENT]),
        changed(quantity="2.5"),
        changed(quantity="99999999999"),
        changed(quantity="1d"),
        changed(quantity=True),
        changed(quantity="2", unit_price="cheap"),
    ],
)
def test_beyond_repair(spark, text):
    rejected = spark.createDataFrame([(text, ARRIVED)], f"{REJECTED} string, kafka_timestamp timestamp")
    assert replay(rejected, ORDER).collect() == []
    assert [r[REJECTED] for r in beyond_repair(rejected, ORDER).collect()] == [text]


def test_rejects_are_parsed_once(spark):
    """The filter by rejects neither parses again nor makes the message again."""
    sent = messages(spark, [changed(quantity="3"), "not json", json.dumps(ORDER_EVENT)], topic=ORDER.topic)
    made = sent.withColumn("raw_json", F.regexp_replace("raw_json", "Chicago", "Dallas"))
    kept = decode_with_rejects(made, ORDER).where("is_rejected").select("kafka_timestamp", REJECTED)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == plan.count("regexp_replace(") == 1
    assert sorted(r[REJECTED] for r in kept.collect()) == sorted(
        [changed(quantity="3").replace("Chicago", "Dallas"), "not json"]
    )


def test_no_rejects(spark):
    none = rejects(spark, ["x"]).limit(0)
    for kind in KINDS:
        assert reject_reasons(none, kind).collect() == []
        assert replay(none, kind).collect() == beyond_repair(none, kind).collect() == []


# Repeats


def landed(spark, bodies, hours=0):
    sent = messages(spark, bodies)
    later = F.col("kafka_timestamp") + F.make_interval(hours=F.lit(hours))
    return lake_rows(sent.withColumn("kafka_timestamp", later), ORDER)


def test_the_first_arrival_stays(spark):
    bodies = [event("order", event_id=f"e{i}") for i in range(20)]
    rows = landed(spark, bodies, 2).unionByName(landed(spark, bodies)).unionByName(
        landed(spark, bodies[:5], 1)
    )
    once = unique_events(rows)
    assert once.columns == rows.columns
    got = once.collect()
    assert sorted(r.event_id for r in got) == sorted(b["event_id"] for b in bodies)
    first = landed(spark, bodies[:1]).first().kafka_timestamp
    assert {r.kafka_timestamp for r in got} == {first}


def test_rows_without_an_id_all_stay(spark):
    rows = lake_rows(messages(spark, ["not json"] * 6, topic=ORDER.topic), ORDER)
    assert unique_events(rows.repartition(3)).count() == 6


def test_equal_times_have_one_answer(spark):
    bodies = [event("order", city=city) for city in ("Dallas", "Chicago", "Phoenix")]
    for order in (bodies, bodies[::-1]):
        kept = unique_events(landed(spark, order)).collect()
        assert [r.city for r in kept] == ["Chicago"]
    assert timedelta(0) == kept[0].kafka_timestamp - landed(spark, bodies).first().kafka_timestamp
