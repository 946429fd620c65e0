"""Dashboards kept current by a stream.

One query reads every message once and keeps everything that the dashboard shows: running
totals and breakdowns, and a point for each micro-batch. Nothing is kept in the engine's
state, so the number of shuffle partitions may change at any restart: a batch writes sums of the
labels and cycles that it touches, which are merged by tiers (see ``tiers``), and its point to the
next slot (see ``slots``).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tallybrook.functions import columns as C
from tallybrook.operators import metrics as M
from tallybrook.sources.messages import POLL_SECONDS
from tallybrook.streaming import slots, tiers

EVERY_CYCLE = {"processingTime": f"{POLL_SECONDS} seconds"}
SLOTS = slots.MARKS

POINT_DDL = f"began double, ended double, orders bigint, revenue {C.MONEY_SUM}"
CYCLE_DDL = f"cycle_start timestamp, orders bigint, revenue {C.MONEY_SUM}"
#: Cycles are rolled up to hours and days beside; 0 stands for the cycles themselves.
HOUR, DAY = 3600, 86400
ROLLED_DDL = f"{CYCLE_DDL}, every int"


def _start(messages: DataFrame, checkpoint: str, trigger, record) -> StreamingQuery:
    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(record)
        .start()
    )


def start_live(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_CYCLE,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Totals, breakdowns and a point for each batch, from the same pass over its messages.

    What is kept is a row per label and one of totals, not a row per combination of labels, and a
    batch writes only what it touches. All of its tasks write: no result is gathered into one.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        began, spark = clock(), batch.sparkSession
        run = slots.run_of(spark, checkpoint)
        folder, slot = f"{path}/{run}", f"slot={batch_id % SLOTS}"
        sums = f"{folder}/sums"
        tiers.add(M.panels(M.facts(batch)), sums, batch_id, M.PANELS_DDL, M.add_up)
        own = tiers.read_own(spark, sums, batch_id, M.PANELS_DDL)
        span = [F.lit(float(at)).alias(name) for name, at in (("began", began), ("ended", clock()))]
        point = M.cycle_total(M.totals_of(own)).select(*span, "orders", "revenue")
        slots.write(point, f"{folder}/points/{slot}", batch_id)
        slots.mark(spark, path, run, batch_id)

    return _start(messages, checkpoint, trigger, record)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The latest sums, a row per panel and label (see ``metrics.panels``)."""
    folder, done = slots.marks(spark, path)
    if not done:
        return spark.createDataFrame([], M.PANELS_DDL)
    return M.add_up(tiers.read(spark, f"{folder}/sums", done[-1], M.PANELS_DDL))


def read_cycles(spark: SparkSession, path: str) -> DataFrame:
    """A row for each of the last 60 batches: batch_id, began, ended, orders, revenue."""
    folder, done = slots.marks(spark, path)
    schema = f"{POINT_DDL}, {slots.MARK_DDL}"
    if not done:
        rows = spark.createDataFrame([], schema)
    else:
        paths = [f"{folder}/points/slot={batch_id % SLOTS}" for batch_id in done]
        rows = spark.read.schema(schema).parquet(*paths).where(F.col("batch_id").isin(done))
    return rows.select(
        "batch_id", "began", "ended", "orders", F.col("revenue").cast("double").alias("revenue")
    )


def cycle_series(
    spark: SparkSession, path: str, now: float | None = None, seconds: int = POLL_SECONDS
) -> DataFrame:
    """The last 60 points up to ``now``: one per batch, however long it took.

    Between batches, and from the last one to ``now``, nothing arrived: a point of zero for
    each whole cycle of it.
    """
    until = F.lit(float(time.time() if now is None else now))
    recorded = read_cycles(spark, path)
    following = F.lead("began").over(Window.orderBy("batch_id"))
    idle = F.coalesce(following, until) - F.col("ended")
    # Of a long silence only the last zeros can be among the last points.
    zeros = F.greatest(F.floor(idle / seconds), F.lit(0))
    oldest = F.greatest(zeros - M.HISTORY, F.lit(0)) + 1
    silent = F.when(zeros > 0, F.sequence(oldest, zeros))
    spans = recorded.withColumn("silent", silent)
    quiet = spans.select("ended", F.explode("silent").alias("nth")).select(
        (F.col("ended") + F.col("nth") * seconds).alias("at"),
        F.lit(0).cast("long").alias("orders"),
        F.lit(0.0).alias("revenue"),
    )
    points = recorded.select(F.col("ended").alias("at"), "orders", "revenue").unionByName(quiet)
    last = points.orderBy(F.desc("at")).limit(M.HISTORY)
    return last.select(
        F.timestamp_millis((F.col("at") * 1000).cast("long")).alias("cycle_at"),
        "orders",
        "revenue",
    ).orderBy("cycle_at")


def _cycle_sums(points: DataFrame, *keys: str) -> DataFrame:
    return points.groupBy("cycle_start", *keys).agg(
        F.sum("orders").alias("orders"),
        F.sum("revenue").cast(C.MONEY_SUM).alias("revenue"),
    )


def _rolled_up(points: DataFrame) -> DataFrame:
    """Points of cycles, and their sums per hour and day, told apart by ``every``."""
    each = points.withColumn("every", F.explode(F.array(F.lit(0), F.lit(HOUR), F.lit(DAY))))
    since = F.unix_seconds("cycle_start")
    start = F.timestamp_seconds(since - F.pmod(since, F.col("every")))
    whole = F.when(F.col("every") == 0, F.col("cycle_start")).otherwise(start)
    return _cycle_sums(each.withColumn("cycle_start", whole), "every")


def start_event_time_cycles(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    seconds: int = POLL_SECONDS,
    trigger: Mapping[str, object] = EVERY_CYCLE,
) -> StreamingQuery:
    """Orders and revenue per cycle of event time, of all events ever; per hour and day as well.

    No event is too late, and none can close another's cycle: a batch writes its own sums per
    cycle, and those of old batches are merged by tiers. A merge costs what its own batches
    touched, not all history.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = slots.run_of(spark, checkpoint)
        points = _rolled_up(M.cycle_points(M.facts(batch), seconds, "event_ts"))
        tiers.add(
            points,
            f"{path}/{run}/cycles",
            batch_id,
            ROLLED_DDL,
            lambda parts: _cycle_sums(parts, "every"),
            ("every",),
        )
        slots.mark(spark, path, run, batch_id)

    return _start(messages, checkpoint, trigger, record)


def read_event_time_cycles(spark: SparkSession, path: str, every: int = 0) -> DataFrame:
    """cycle_start, orders and revenue of every cycle with an event, or of hours or days.

    ``every`` is 0, ``HOUR`` or ``DAY``; files of the others are not opened.
    """
    if every not in (0, HOUR, DAY):
        raise ValueError(f"cycles are rolled up to {HOUR} and {DAY} seconds, not {every}")
    folder, done = slots.marks(spark, path)
    if not done:
        parts = spark.createDataFrame([], CYCLE_DDL)
    else:
        parts = tiers.read(spark, f"{folder}/cycles", done[-1], ROLLED_DDL).where(
            F.col("every") == every
        )
    return _cycle_sums(parts).withColumn("revenue", F.col("revenue").cast("double"))
