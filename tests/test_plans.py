"""What Spark makes of the queries: what is read, parsed, shuffled and broadcast."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from support import CLICK_EVENT, ORDER_EVENT, PAYMENT_EVENT, raw
from tallybrook.operators import metrics as M
from tallybrook.operators import pricing as P
from tallybrook.operators.decode import decode_with_rejects
from tallybrook.operators.enrich import enrich, lake_rows
from tallybrook.plans.queries import REGISTRY
from tallybrook.schemas import KINDS, ORDER
from tallybrook.sources import tables
from tallybrook.sources.lake import read_lake, settle, settled
from tallybrook.sources.messages import batch_messages, stream_messages
from tallybrook.streaming import ingest


def plan(frame):
    """The physical plan, as one text."""
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "log")
    raw(spark, [ORDER_EVENT, CLICK_EVENT, PAYMENT_EVENT]).write.parquet(path)
    return path


@pytest.mark.parametrize("kind", KINDS, ids=lambda kind: kind.name)
def test_ingest_shuffles_nothing_and_parses_once(spark, log, kind):
    rows = lake_rows(batch_messages(spark, "parquet", path=log), kind)
    assert "Exchange" not in plan(rows)
    assert plan(rows).count("from_json(") == 1
    assert f"EqualTo(topic,{kind.topic})" in plan(rows)
    assert "ReadSchema: struct<value:binary,topic:string,timestamp:timestamp>" in plan(rows)


def test_marking_rejects_parses_once(spark, log):
    rows = enrich(decode_with_rejects(batch_messages(spark, "parquet", path=log), ORDER), ORDER)
    assert plan(rows).count("from_json(") == 1
    assert "Exchange" not in plan(rows)


METRICS = {
    "kpi_totals": M.kpi_totals,
    "orders_by_category": M.orders_by_category,
    "orders_by_device": M.orders_by_device,
    "payments_by_method": M.payments_by_method,
    "top_cities_by_revenue": M.top_cities_by_revenue,
    "breakdowns": lambda facts: M.breakdowns(M.panels(facts)),
    "last_cycles": lambda facts: M.last_cycles(M.cycle_points(facts, 60), 60),
}


@pytest.mark.parametrize("name", sorted(METRICS))
def test_metrics_read_and_parse_once(spark, log, name):
    result = METRICS[name](M.facts(batch_messages(spark, "parquet", path=log)))
    text = plan(result)
    assert text.count("from_json(") == 1
    assert text.count("FileScan") == 1
    assert "partial_sum" in text
    assert "Join" not in text


def test_top_cities_are_not_sorted_as_a_whole(spark, log):
    facts = M.facts(batch_messages(spark, "parquet", path=log))
    assert "TakeOrderedAndProject" in plan(M.top_cities_by_revenue(facts))
    assert "TakeOrderedAndProject" in plan(M.last_cycles(M.cycle_points(facts, 60), 60))


def test_throughput_reads_the_arrival_time_only(spark, log):
    text = plan(M.throughput(batch_messages(spark, "parquet", path=log)))
    assert "ReadSchema: struct<timestamp:timestamp>" in text
    assert "from_json" not in text


def test_table_filter_reaches_the_scan(spark, sf_dir):
    text = plan(M.orders_by_device(M.facts(tables.messages(spark, sf_dir, ORDER))))
    assert "EqualTo(event_type,purchase)" in text


def test_settled_hours_are_read_by_their_directories(spark, tmp_path):
    """Not through the sink's list of every file it ever wrote."""
    lake, log = str(tmp_path / "lake"), str(tmp_path / "log")
    raw(spark, [ORDER_EVENT]).write.parquet(log)
    arrived = stream_messages(spark, "parquet", path=log)
    options = {"trigger": {"availableNow": True}}
    ingest.finish([ingest.land(arrived, ORDER, lake, str(tmp_path / "state"), **options)])
    assert "MetadataLogFileIndex" in plan(read_lake(spark, lake, ORDER))
    assert settle(spark, lake, ORDER) == 0
    text = plan(settled(spark, lake, ORDER).where("date = '2026-03-13'"))
    assert "MetadataLogFileIndex" not in text and "FileScan" in text
    assert "PartitionFilters: [isnotnull(date" in text


def test_lake_read_prunes_directories(spark, log, tmp_path):
    lake = str(tmp_path / "lake")
    arrived = stream_messages(spark, "parquet", path=log)
    options = {"trigger": {"availableNow": True}}
    ingest.finish([ingest.land(arrived, ORDER, lake, str(tmp_path / "state"), **options)])
    rows = read_lake(spark, lake, ORDER)
    one = rows.where((F.col("date") == "2026-03-13") & (F.col("hour") >= 14)).select("event_id")
    text = plan(one)
    assert "PartitionFilters: [isnotnull(date" in text and "(hour" in text
    assert "ReadSchema: struct<event_id:string>" in text
    assert one.count() == 1


def test_lake_facts_read_narrow_columns_and_parse_nothing(spark, log, tmp_path):
    lake = str(tmp_path / "lake")
    options = {"trigger": {"availableNow": True}}
    arrived = stream_messages(spark, "parquet", path=log)
    ingest.finish(ingest.land_all(lambda _: arrived, lake, str(tmp_path / "state"), **options))
    tables_ = [read_lake(spark, lake, kind).where("date >= '2026-03-13'") for kind in KINDS]
    totals = M.kpi_totals(M.lake_facts(*tables_))
    text = plan(totals)
    assert "from_json" not in text
    assert text.count("PartitionFilters: [isnotnull(date") == 3
    assert "ReadSchema: struct<event_type:string,total_amount:double,status:string>" in text
    assert "ReadSchema: struct<event_type:string>" in text
    from_messages = M.facts(batch_messages(spark, "parquet", path=log))
    assert totals.first() == M.kpi_totals(from_messages).first()
    # One table alone will do for the metrics of its kind.
    for table, metric in zip(tables_, (M.orders_by_category, M.kpi_totals, M.payments_by_method)):
        assert metric(M.lake_facts(table)).count() == 1
    alone = M.top_cities_by_revenue(M.lake_facts(tables_[0])).first()
    assert (alone.city, alone.revenue) == ("Chicago", 171.45)


def test_catalogue_is_broadcast_by_size_only(spark):
    events = spark.range(1000).select(F.col("id").cast("string").alias("product_id"))
    small = spark.range(10).select(F.col("id").cast("string").alias("product_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan(P.attach_products(events, small))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(P.attach_products(events, small))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_events_are_counted_before_the_join(spark, sf_dir):
    text = plan(REGISTRY["catalog_denormalise"](spark, sf_dir))
    join = text.index("Join")
    assert "HashAggregate" in text[join:]


STREAMED = ("stream_", "publish_then_", "publish_rejects", "lake_")


@pytest.mark.parametrize(
    "name", sorted(name for name in REGISTRY if not name.startswith(STREAMED))
)
def test_no_python_and_no_product_of_tables(spark, sf_dir, name):
    text = plan(REGISTRY[name](spark, sf_dir))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_a_hot_product_is_split(spark):
    """A third of the events on one product: adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        events = spark.range(0, 200_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("product_id")
        )
        products = spark.range(200_000).select(F.col("id").alias("product_id"), F.lit(1).alias("x"))
        joined = P.attach_products(events, products)
        total = joined.agg(F.sum("x"))
        assert total.collect()[0][0] == 200_000
        assert "skew=true" in plan(total)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
