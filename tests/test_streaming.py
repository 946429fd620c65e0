"""Landing events: the same rows as in batch, across restarts, late and broken input."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from support import CLICK_EVENT, ORDER_EVENT, PAYMENT_EVENT, event, raw
from tallybrook.operators.enrich import lake_rows
from tallybrook.schemas import KINDS, ORDER
from tallybrook.sources import tables
from tallybrook.sources.lake import read_lake, table_path
from tallybrook.sources.messages import batch_messages, stream_messages
from tallybrook.streaming import ingest

ONCE = {"availableNow": True}


@pytest.fixture
def folders(tmp_path):
    names = ("log", "lake", "checkpoints")
    return {name: str(tmp_path / name) for name in names}


def append(spark, folders, values, topic=None, arrived=None):
    extra = {} if arrived is None else {"arrived": arrived}
    raw(spark, values, topic, **extra).write.mode("append").parquet(folders["log"])


def land(spark, folders, kinds=KINDS, **options):
    queries = ingest.land_all(
        lambda kind: stream_messages(spark, "parquet", path=folders["log"]),
        folders["lake"],
        folders["checkpoints"],
        kinds=kinds,
        trigger=ONCE,
        **options,
    )
    ingest.finish(queries)
    return queries


def ids(spark, folders, kind=ORDER):
    return sorted(row.event_id or "" for row in read_lake(spark, folders["lake"], kind).collect())


def test_stream_equals_batch(spark, folders):
    append(spark, folders, [ORDER_EVENT, CLICK_EVENT, PAYMENT_EVENT, event("order", event_id="e9")])
    append(spark, folders, ["not json", None], topic="ecommerce.orders")
    land(spark, folders)
    logged = batch_messages(spark, "parquet", path=folders["log"])
    for kind in KINDS:
        landed = read_lake(spark, folders["lake"], kind)
        assert landed.columns == list(kind.lake_fields)
        assert landed.columns[-2:] == ["date", "hour"]
        batch = lake_rows(logged, kind).select(*landed.columns).drop("ingest_ts")
        landed = landed.drop("ingest_ts")
        assert landed.count() > 0
        assert landed.exceptAll(batch).count() == batch.exceptAll(landed).count() == 0


def table_stream(spark, sf_dir, *kinds):
    rows = tables.event_rows(tables.stream_events(spark, sf_dir), kinds)
    return tables.as_messages(rows, kinds)


def test_only_the_table_itself_is_streamed(spark, sf_dir, tmp_path, folders):
    """Not another file beside it with a similar name."""
    rows = tables.read_events(spark, sf_dir).coalesce(1)
    for name in ("events", "events_old", "eventsX"):
        rows.write.parquet(str(tmp_path / "sf" / f"{name}.parquet"))
    arriving = table_stream(spark, str(tmp_path / "sf"), ORDER)
    options = {"trigger": ONCE}
    ingest.finish([ingest.land(arriving, ORDER, folders["lake"], folders["checkpoints"], **options)])
    want = rows.where("event_type = 'purchase'").count()
    assert read_lake(spark, folders["lake"], ORDER).count() == want


def test_table_stream_equals_batch(spark, sf_dir, folders):
    queries = ingest.land_all(
        lambda kind: table_stream(spark, sf_dir, kind),
        folders["lake"],
        folders["checkpoints"],
        trigger=ONCE,
    )
    ingest.finish(queries)
    for kind in KINDS:
        landed = read_lake(spark, folders["lake"], kind).drop("ingest_ts")
        batch = lake_rows(tables.messages(spark, sf_dir), kind).select(*landed.columns)
        assert landed.count() == batch.count()
        assert landed.exceptAll(batch).count() == 0


def test_restart_neither_loses_nor_repeats(spark, folders):
    append(spark, folders, [ORDER_EVENT])
    land(spark, folders, [ORDER])
    land(spark, folders, [ORDER])
    assert ids(spark, folders) == ["e1"]
    append(spark, folders, [event("order", event_id="e2"), event("order", event_id="e2")])
    land(spark, folders, [ORDER])
    # Repeated messages are the sender's; they are kept.
    assert ids(spark, folders) == ["e1", "e2", "e2"]


def test_a_batch_that_dies_half_way_is_repeated_cleanly(spark, folders):
    append(spark, folders, [ORDER_EVENT])
    land(spark, folders, [ORDER])
    for number in range(2, 8):
        append(spark, folders, [event("order", event_id=f"e{number}")])
    # One task of the second batch fails; the others have written their files by then.
    poisoned = F.col("raw_json").contains('"e4"')
    failing = stream_messages(spark, "parquet", path=folders["log"]).withColumn(
        "raw_json",
        F.when(poisoned, F.raise_error(F.lit("lost"))).otherwise(F.col("raw_json")),
    )
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        options = {"trigger": ONCE}
        dying = ingest.land(failing, ORDER, folders["lake"], folders["checkpoints"], **options)
        with pytest.raises(StreamingQueryException):
            ingest.finish([dying])
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert ids(spark, folders) == ["e1"]
    land(spark, folders, [ORDER])
    assert ids(spark, folders) == [f"e{number}" for number in range(1, 8)]


def test_late_event_lands_where_it_happened(spark, folders):
    append(spark, folders, [ORDER_EVENT])
    land(spark, folders, [ORDER])
    late = event("order", event_id="late", timestamp="2025-01-01T07:30:00")
    append(spark, folders, [late], arrived=datetime(2026, 3, 14, tzinfo=timezone.utc))
    land(spark, folders, [ORDER])
    assert ids(spark, folders) == ["e1", "late"]
    partition = f"{table_path(folders['lake'], ORDER)}/date=2025-01-01/hour=7"
    assert [row.event_id for row in spark.read.parquet(partition).collect()] == ["late"]


def test_unreadable_events_have_their_own_partition(spark, folders):
    append(spark, folders, ["not json", ""], topic="ecommerce.orders")
    append(spark, folders, [event("order", timestamp="bad")])
    land(spark, folders, [ORDER])
    name = "__HIVE_DEFAULT_PARTITION__"
    partition = f"{table_path(folders['lake'], ORDER)}/date={name}/hour={name}"
    assert spark.read.parquet(partition).count() == 3
    rows = read_lake(spark, folders["lake"], ORDER).where("date IS NULL AND hour IS NULL")
    assert rows.count() == 3


def test_clustering_keeps_every_row_and_saves_files(spark, sf_dir, folders):
    def split(kind):
        return table_stream(spark, sf_dir, kind).repartition(6)

    files = {}
    for mixed in (False, True):
        lake, state = f"{folders['lake']}-{mixed}", f"{folders['checkpoints']}-{mixed}"
        options = {"kinds": [ORDER], "trigger": ONCE, "gather_hours": mixed}
        ingest.finish(ingest.land_all(split, lake, state, **options))
        landed = read_lake(spark, lake, ORDER)
        files[mixed] = (landed.count(), len(landed.inputFiles()))
    assert files[True][0] == files[False][0]
    hours = tables.read_events(spark, sf_dir).where("event_type = 'purchase'")
    hours = hours.select(F.date_trunc("hour", "ts")).distinct().count()
    assert files[True][1] == hours < files[False][1]


def test_a_hot_hour_is_split_over_tasks(spark, folders):
    """A third of the events in one hour, a third unreadable: neither becomes one task."""
    n = F.col("n")
    hour = F.when(n % 3 == 0, 14).otherwise((n % 24).cast("int"))
    text = F.col("value").cast("string")
    text = F.replace(text, F.lit("T14:05:06.123456"), F.format_string("T%02d:00:00", hour))
    text = F.replace(text, F.lit("e1"), F.sha2(n.cast("string"), 256))
    broken = F.when(n % 3 == 1, F.concat(F.lit("x"), text)).otherwise(text)
    one = raw(spark, [event("order")])
    many = one.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(59_999))))
    log = many.withColumn("value", broken.cast("binary")).drop("n")
    log.repartition(8).write.parquet(folders["log"])
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "128KB")
    try:
        land(spark, folders, [ORDER])
    finally:
        spark.conf.unset(setting)
    rows = read_lake(spark, folders["lake"], ORDER)
    assert rows.count() == 60000
    files = rows.select("hour", F.input_file_name().alias("file")).distinct()
    counts = dict(files.groupBy("hour").count().collect())
    assert counts[14] > 1 and counts[None] > 1


def test_message_files_may_have_another_format(spark, folders):
    text = raw(spark, [ORDER_EVENT]).select(
        F.base64("key").alias("key"), F.base64("value").alias("value"), "topic", "timestamp"
    )
    text.write.json(folders["log"])
    arrived = batch_messages(spark, "json", path=folders["log"])
    assert lake_rows(arrived, ORDER).first().event_id == "e1"


def test_bounded_micro_batches(spark, folders):
    for number in range(5):
        append(spark, folders, [event("order", event_id=str(number))])
    query = ingest.land(
        stream_messages(spark, "parquet", {"maxFilesPerTrigger": "2"}, folders["log"]),
        ORDER,
        folders["lake"],
        folders["checkpoints"],
        trigger=ONCE,
    )
    ingest.finish([query])
    rates = [rate for rate in ingest.rates(query) if rate["rows"]]
    assert [rate["rows"] for rate in rates] == [2, 2, 1]
    assert [rate["batch_id"] for rate in rates] == [0, 1, 2]
    assert all(rate["rows_per_second"] > 0 for rate in rates)
    assert ids(spark, folders) == ["0", "1", "2", "3", "4"]


def test_one_failure_ends_all(spark, folders):
    append(spark, folders, [ORDER_EVENT])
    arrived = stream_messages(spark, "parquet", path=folders["log"])
    steady = ingest.land(arrived, ORDER, folders["lake"], folders["checkpoints"])
    broken = (
        arrived.select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
        .writeStream.format("noop")
        .option("checkpointLocation", folders["checkpoints"] + "-broken")
        .start()
    )
    with pytest.raises(StreamingQueryException, match="broken"):
        ingest.supervise([steady, broken])
    assert not steady.isActive and not broken.isActive


def test_siblings_of_a_failed_query_are_stopped(spark, folders):
    append(spark, folders, [ORDER_EVENT])
    arrived = stream_messages(spark, "parquet", path=folders["log"])
    broken = (
        arrived.select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
        .writeStream.format("noop")
        .option("checkpointLocation", folders["checkpoints"] + "-broken")
        .trigger(**ONCE)
        .start()
    )
    steady = ingest.land(arrived, ORDER, folders["lake"], folders["checkpoints"])
    with pytest.raises(StreamingQueryException, match="broken"):
        ingest.finish([broken, steady])
    assert not steady.isActive


def test_nothing_is_left_running_when_one_can_not_start(spark, folders):
    append(spark, folders, [ORDER_EVENT])
    before = {query.id for query in spark.streams.active}

    def messages_of(kind):
        if kind is not ORDER:
            raise RuntimeError("no such topic")
        return stream_messages(spark, "parquet", path=folders["log"])

    with pytest.raises(RuntimeError):
        ingest.land_all(messages_of, folders["lake"], folders["checkpoints"])
    assert {query.id for query in spark.streams.active} == before


def test_rejects_keep_their_text(spark, folders, tmp_path):
    append(spark, folders, ["not json", None, '{"quantity": "x"}'], topic="ecommerce.orders")
    append(spark, folders, [ORDER_EVENT])
    rejects = str(tmp_path / "rejects")
    land(spark, folders, [ORDER], rejects=rejects)
    assert read_lake(spark, folders["lake"], ORDER).count() == 4
    kept = spark.read.parquet(f"{rejects}/orders").collect()
    assert sorted(str(row.rejected_json) for row in kept) == ["None", "not json", '{"quantity": "x"}']
    assert {row.topic for row in kept} == {"ecommerce.orders"}


def test_lake_schema_is_what_the_files_hold(spark, folders):
    append(spark, folders, [ORDER_EVENT, CLICK_EVENT, PAYMENT_EVENT])
    land(spark, folders)
    for kind in KINDS:
        found = spark.read.parquet(table_path(folders["lake"], kind))
        assert dict(found.dtypes) == kind.lake_fields
