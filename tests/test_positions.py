"""Gaps in a log, by partition and offset."""

from __future__ import annotations

import random

import pytest

from support import event, raw
from pyspark.sql import functions as F
from tallybrook.operators import positions as P
from tallybrook.sources.messages import batch_messages

DDL = "topic string, partition int, offset bigint"


def brute(rows):
    gaps = []
    for topic, partition in {row[:2] for row in rows}:
        there = sorted({row[2] for row in rows if row[:2] == (topic, partition) and row[2] is not None})
        gaps += [
            (topic, partition, a + 1, b - 1, b - a - 1) for a, b in zip(there, there[1:]) if b > a + 1
        ]
    return sorted(gaps)


@pytest.mark.parametrize("share", [0.03, 0.5, 0.97])
def test_gaps_of_any_density(spark, share):
    rng = random.Random(7)
    rows = [
        (topic, partition, base + offset)
        for topic, partition, base in (("a", 0, 0), ("a", 1, 60), ("b", 0, 10**15))
        for offset in range(700)
        if rng.random() < share
    ]
    rows += rng.sample(rows, len(rows) // 3) + [("a", 0, None), ("c", 5, 63), ("c", 5, 64)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, DDL)
    assert sorted(map(tuple, P.offset_gaps(frame).collect())) == brute(rows)
    for row in P.offset_coverage(frame).collect():
        there = [o for t, p, o in rows if (t, p) == (row.topic, row.partition) and o is not None]
        found = (row.first_offset, row.last_offset, row.present, row.missing, row.repeated)
        own = len(set(there))
        want = (min(there), max(there), own, max(there) - min(there) + 1 - own, len(there) - own)
        assert found == want


def test_a_log_without_holes(spark):
    frame = spark.range(1000).select(F.lit("a").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    assert P.offset_gaps(frame).count() == 0
    assert P.offset_coverage(frame).first().missing == 0
    assert P.offset_gaps(frame.limit(0)).count() == 0


def test_positions_travel_with_messages_and_read_no_texts(spark, tmp_path):
    log = str(tmp_path / "log")
    sent = raw(spark, [event("order"), event("click"), event("payment")])
    placed = sent.withColumn("partition", F.lit(2)).withColumn("offset", F.lit(7).cast("long"))
    placed.write.parquet(log)
    arrived = batch_messages(spark, "parquet", path=log, positions=True)
    assert arrived.columns[-2:] == ["partition", "offset"]
    assert "offset" not in batch_messages(spark, "parquet", path=log).columns
    plan = P.offset_coverage(arrived)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint>" in plan
