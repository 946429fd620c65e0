"""Settling a live table: snapshots by batch, levels of parts, files that are skipped."""

from __future__ import annotations

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from support import CLICK_EVENT, event, raw
from tallybrook.schemas import ORDER
from tallybrook.sources import lake as L
from tallybrook.sources.messages import stream_messages
from tallybrook.streaming import ingest


class Table:
    """An orders table that grows by one committed batch at a time."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        self.lake, self.log = str(tmp_path / "lake"), str(tmp_path / "log")

    def land(self, *ids, events=None, **changes):
        texts = events or [event("order", event_id=name, **changes) for name in ids]
        raw(self.spark, texts).coalesce(1).write.mode("append").parquet(self.log)
        arrived = stream_messages(self.spark, "parquet", path=self.log)
        state = str(self.root / "state")
        ingest.finish(
            [ingest.land(arrived, ORDER, self.lake, state, trigger={"availableNow": True})]
        )

    def settle(self, *args, **options):
        return L.settle(self.spark, self.lake, ORDER, *args, **options)

    def shot(self):
        return L.snapshot(self.spark, self.lake, ORDER)

    def read(self, **span):
        return L.read_lake(self.spark, self.lake, ORDER, **span)

    def ids(self):
        return sorted(row.event_id for row in self.read().collect())

    def settled(self):
        return L.settled(self.spark, self.lake, ORDER).count()


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, tmp_path)


def test_settled_and_live_rows_are_each_read_once(table):
    """Before, between and after settling, with a late event for a settled hour."""
    table.land(events=[CLICK_EVENT])
    table.settle()
    assert table.ids() == []
    table.land("a")
    assert (table.settled(), table.ids()) == (0, ["a"])
    table.settle()
    assert (table.settled(), table.ids()) == (1, ["a"])
    table.land("b")
    table.land("c", timestamp="2026-03-13T14:00:00")
    assert (table.settled(), table.ids()) == (1, ["a", "b", "c"])
    last = table.settle()
    assert table.settle() == last
    assert (table.settled(), table.ids()) == (3, ["a", "b", "c"])


def test_a_table_that_no_stream_has_written_yet(spark, tmp_path):
    lake = str(tmp_path / "lake")
    assert L.settle(spark, lake, ORDER) is None
    assert L.settled(spark, lake, ORDER).count() == 0


def test_a_clock_that_goes_back_loses_nothing(spark, table, monkeypatch):
    """20 rows settled, then 5 of a batch that is stamped 40 seconds earlier."""
    table.land(*[f"a{i:02}" for i in range(20)])
    table.settle()
    stamps = F.current_timestamp
    monkeypatch.setattr(
        "tallybrook.operators.enrich.F.current_timestamp", lambda: stamps() - F.expr("INTERVAL 40 SECONDS")
    )
    table.land(*[f"b{i}" for i in range(5)])
    monkeypatch.undo()
    times = table.read().groupBy(F.left("event_id", F.lit(1)).alias("of")).agg(F.max("ingest_ts").alias("at"))
    at = {row["of"]: row["at"] for row in times.collect()}
    assert at["b"] < at["a"]
    assert table.read().count() == 25
    table.settle()
    assert (table.settled(), table.read().count()) == (25, 25)


def test_batches_after_the_given_one_stay_live(table):
    for name in "abcd":
        table.land(name)
    assert table.settle(through=1) == 1
    assert (table.settled(), table.ids()) == (2, list("abcd"))
    assert table.settle() == 3
    assert (table.settled(), table.ids()) == (4, list("abcd"))


def test_the_sinks_summaries_hide_no_file(spark, table):
    """The sink sums up its log every ten batches; files are known by name all the same."""
    want = []
    for number in range(13):
        want.append(f"{number:02}")
        table.land(want[-1])
        if number == 3:
            table.settle()
    log = os.listdir(f"{table.lake}/orders/_spark_metadata")
    assert sum(name.endswith(".compact") for name in log if not name.startswith(".")) >= 1
    # What the sink does after its clean-up delay.
    for name in log:
        if name.strip(".").split(".")[0].isdigit() and int(name.strip(".").split(".")[0]) < 9:
            os.remove(f"{table.lake}/orders/_spark_metadata/{name}")
    assert (table.settled(), table.ids()) == (4, want)
    assert table.settle() == 12
    assert (table.settled(), table.ids()) == (13, want)


def test_many_settlings_make_few_parts(spark, table):
    want, most = [], 0
    for number in range(7):
        want.append(f"{number:02}")
        table.land(want[-1], timestamp=f"2026-03-13T{number % 5:02}:00:00")
        table.settle(fanout=2)
        most = max(most, len(table.shot().parts))
    # 7 is 111 in twos: a part of four settlings, one of two, one of one.
    assert [part.level for part in table.shot().parts] == [2, 1, 0]
    assert most <= 3 and table.ids() == want and table.settled() == 7
    assert [part.first_batch for part in table.shot().parts] == [0, 4, 6]
    # A whole year of hours: at most seven parts of each of five levels.
    assert (L.FANOUT - 1) * 5 >= 35 and L.FANOUT**5 > 8760
    parts = os.listdir(f"{table.lake}/settled/orders/parts")
    named = {f"part={part.part}" for part in table.shot().parts}
    assert named <= set(parts) and len(parts) <= len(named) + 4
    assert len(os.listdir(f"{table.lake}/settled/orders/snapshots")) == 2


def test_hours_of_a_merged_part_have_one_file_each(spark, table):
    for name in "abc":
        table.land(f"{name}1", timestamp="2026-03-13T01:00:00")
        table.land(f"{name}2", timestamp="2026-03-13T02:00:00")
        table.settle(fanout=3)
    files = L.settled(spark, table.lake, ORDER).inputFiles()
    assert len(files) == 2 and table.settled() == 6


def test_a_large_hour_has_several_files(spark, table, monkeypatch):
    table.land(*[f"{i:04}" for i in range(400)])
    table.land("late", timestamp="2026-03-13T02:00:00")
    monkeypatch.setattr(L, "FILE_BYTES", 2000)
    monkeypatch.setattr(L, "FILES_A_TASK", 1)
    table.settle()
    files = L.settled(spark, table.lake, ORDER).inputFiles()
    assert len(files) > 3 and table.settled() == 401
    counts = L.settled(spark, table.lake, ORDER).groupBy(F.input_file_name()).count()
    assert counts.agg(F.max("count")).first()[0] < 200


def test_the_tail_opens_only_files_after_the_snapshot(spark, table):
    for name in "abcdef":
        table.land(name)
    assert len(table.read().inputFiles()) == 6
    table.settle()
    for name in "gh":
        table.land(name)
    tail = L.tail(spark, table.lake, ORDER, table.shot())
    assert len(tail.inputFiles()) == 2 and tail.count() == 2
    # One file holds the settled hour, two are live.
    assert len(table.read().inputFiles()) == 3
    plan = table.read().where("date = '2026-03-13'")._jdf.queryExecution().executedPlan().toString()
    assert "MetadataLogFileIndex" not in plan
    assert plan.count("FileScan") == plan.count("PartitionFilters: [isnotnull(date") == 2


def test_a_span_of_arrival_opens_only_its_files(spark, table):
    for name in "abcd":
        table.land(name)
        table.settle(fanout=99)
    times = {row.event_id: row.ingest_ts for row in table.read().collect()}
    span = {"arrived_from": times["b"], "arrived_before": times["d"]}
    rows = table.read(**span)
    assert sorted(row.event_id for row in rows.collect()) == ["b", "c"]
    assert len(rows.inputFiles()) == 2 and len(table.read().inputFiles()) == 4
    table.land("e")
    later = {"arrived_from": times["d"] + timedelta(microseconds=1)}
    assert [row.event_id for row in table.read(**later).collect()] == ["e"]


@pytest.mark.parametrize("step", ["_write_part", "_commit"])
def test_a_settling_that_died_is_repeated(table, monkeypatch, step):
    table.land("a")
    table.settle()
    table.land("b")
    done = getattr(L, step)

    def dies(*args):
        if step == "_write_part":
            done(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(L, step, dies)
    with pytest.raises(RuntimeError):
        table.settle()
    monkeypatch.undo()
    assert (table.settled(), table.ids()) == (1, ["a", "b"])
    table.settle()
    assert (table.settled(), table.ids()) == (2, ["a", "b"])
    table.land("c")
    table.settle()
    # Nothing of the run that died is left.
    assert len(os.listdir(f"{table.lake}/settled/orders/parts")) == 3


def test_a_half_written_snapshot_is_not_read(spark, table):
    table.land("a")
    table.settle()
    table.land("b")
    rows = [("x", 0, 0, 0, 1, None, None, True, 2)]
    path = f"{table.lake}/settled/orders/snapshots/version=2"
    spark.createDataFrame(rows, L.PART_DDL).write.parquet(path)
    assert table.shot().version == 1 and table.ids() == ["a", "b"]
    table.settle()
    assert table.shot().version == 2 and table.ids() == ["a", "b"]


def test_live_files_go_once_two_snapshots_cover_them(spark, table):
    def live():
        return sum(
            name.endswith(".parquet")
            for _, _, names in os.walk(f"{table.lake}/orders")
            for name in names
            if not name.startswith(".")
        )

    want = []
    for number in range(4):
        want.append(str(number))
        table.land(want[-1])
        table.settle(fanout=2, drop_live=True)
        assert live() == 1
        assert table.ids() == want
    assert table.settled() == 4


def test_landing_has_no_option_that_forgets_files(table):
    with pytest.raises(TypeError):
        ingest.land(None, ORDER, table.lake, "state", retention="1h")
