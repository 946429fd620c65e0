"""Rules that hold for any input."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import event, messages
from tallybrook.functions import columns as C
from tallybrook.operators import metrics as M
from tallybrook.operators.decode import decode, envelope
from tallybrook.operators.publish import publish_frame
from tallybrook.schemas import ORDER, ddl

FEW = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
TEXT = st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=12)
FLOATS = st.floats(allow_nan=False, allow_infinity=False, width=64)


@FEW
@given(st.lists(st.one_of(st.none(), st.floats()), min_size=1, max_size=40))
def test_tiers_partition_the_line(spark, prices):
    frame = spark.createDataFrame([(p,) for p in prices], "p double")
    for price, tier in frame.select("p", C.price_tier(F.col("p"))).collect():
        low, middle = price is not None and price < 25, price is not None and price < 75
        assert tier == ("budget" if low else "mid" if middle else "premium")


@FEW
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(0, 10**12)), min_size=1, max_size=40))
def test_success_rate_is_a_percentage(spark, pairs):
    rows = [(min(pair), max(pair)) for pair in pairs]
    frame = spark.createDataFrame(rows, "f bigint, t bigint")
    rates = frame.select(C.success_rate(F.col("f"), F.col("t"))).collect()
    assert all(0 <= rate[0] <= 100 for rate in rates)


@FEW
@given(st.lists(st.tuples(st.sampled_from(["order", "click", "payment", "x"]), TEXT), max_size=30))
def test_breakdowns_add_up_to_the_totals(spark, drawn):
    kinds = {"x": "click"}
    sent = [
        event(kinds.get(kind, kind), event_type=kind, city=label, category=label, device=label)
        for kind, label in drawn
    ]
    facts = M.facts(messages(spark, sent or [None], topic="ecommerce.orders"))
    totals = M.kpi_totals(facts).first()
    assert totals.total_orders == sum(kind == "order" for kind, _ in drawn)
    sums = dict(
        map(tuple, M.breakdowns(M.panels(facts)).groupBy("panel").agg(F.sum("events")).collect())
    )
    for panel in ("category", "city", "device"):
        assert sums.get(panel, 0) == totals.total_orders
    assert sums.get("payment_method", 0) == totals.total_payments


@FEW
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                name: st.one_of(
                    st.none(),
                    {"string": TEXT, "int": st.integers(-(2**31), 2**31 - 1), "double": FLOATS}[
                        dtype
                    ],
                )
                for name, dtype in ORDER.fields.items()
                if name != "event_type"
            }
        ),
        min_size=1,
        max_size=10,
    )
)
def test_published_orders_come_back_unchanged(spark, drawn):
    bodies = [{"event_type": "order", **body} for body in drawn]
    rows = [tuple(body[name] for name in ORDER.fields) for body in bodies]
    frame = spark.createDataFrame(rows, ddl(ORDER.fields)).coalesce(1)
    published = publish_frame(frame).withColumn("timestamp", F.current_timestamp())
    for row, body in zip(published.collect(), bodies):
        assert json.loads(row.value) == body
    back = decode(envelope(published), ORDER).drop("kafka_timestamp").collect()
    assert [row.asDict() for row in back] == bodies
