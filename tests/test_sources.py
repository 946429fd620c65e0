"""Options, folders and arguments."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tallybrook import app
from tallybrook.plans.workspace import fresh_folder
from tallybrook.schemas import CLICK, ORDER, PAYMENT, TOPICS
from tallybrook.sources import messages as source


def test_topics():
    assert TOPICS == ("ecommerce.orders", "ecommerce.clicks", "ecommerce.payments")
    assert [kind.table for kind in (ORDER, CLICK, PAYMENT)] == ["orders", "clicks", "payments"]


def test_source_options():
    assert source.kafka_source_options("b:1") == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "ecommerce.orders,ecommerce.clicks,ecommerce.payments",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    bounded = source.kafka_source_options(
        "b:1", [CLICK.topic], starting="earliest", max_per_trigger=500, max_per_task=10
    )
    assert bounded["subscribe"] == "ecommerce.clicks"
    assert bounded["startingOffsets"] == "earliest"
    assert bounded["maxOffsetsPerTrigger"] == "500"
    assert bounded["maxRecordsPerPartition"] == "10"
    assert source.kafka_source_options("b:1", fail_on_data_loss=True)["failOnDataLoss"] == "true"


def test_sink_options():
    assert source.kafka_sink_options("b:1") == {
        "kafka.bootstrap.servers": "b:1",
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "10",
        "kafka.batch.size": "16384",
    }


def test_folders_are_fresh(spark):
    one, two = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert one != two


class Session:
    """What a folder depends on: where the session runs, and its shared folder."""

    def __init__(self, master, shared):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda name, default: shared or default)


@pytest.mark.parametrize("master", ["yarn", "local[4]", "spark://host:7077"])
def test_the_shared_folder_is_used_where_named(master):
    assert fresh_folder(Session(master, "s3a://b/shared/"), "x").startswith("s3a://b/shared/x-")


def test_a_local_session_may_use_its_own_folder():
    folders = [fresh_folder(Session("local[4]", None), "x") for _ in range(2)]
    assert len({folder.rsplit("/", 1)[0] for folder in folders}) == 1


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        fresh_folder(Session("yarn", None), "x")


def test_arguments(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:9")
    monkeypatch.setenv("S3_BUCKET", "bucket")
    monkeypatch.setenv("S3_PREFIX", "prefix")
    parsed = app.arguments().parse_args(["ingest"])
    assert (parsed.servers, parsed.base) == ("broker:9", "s3a://bucket/prefix")
    assert parsed.run is app.run_ingest and parsed.starting == "latest"
    assert parsed.max_per_trigger is None and not parsed.fail_on_data_loss
    monkeypatch.delenv("S3_PREFIX")
    assert app.arguments().parse_args(["live"]).base == "s3a://bucket"
    monkeypatch.delenv("S3_BUCKET")
    with pytest.raises(SystemExit):
        app.arguments().parse_args(["ingest"])
    assert app.arguments().parse_args(["ingest", "--base", "/x"]).base == "/x"
    assert app.arguments().parse_args(["publish", "--events", "/x"]).run is app.run_publish
