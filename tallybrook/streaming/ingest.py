"""Landing events in the lake, one query per kind."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook.operators.decode import REJECTED, decode_with_rejects
from tallybrook.operators.enrich import lake_rows
from tallybrook.schemas import KINDS, EventKind
from tallybrook.sources.lake import table_path

PARTITIONS = ("date", "hour")
EVERY_30_SECONDS = {"processingTime": "30 seconds"}
#: A backfill has many hours of few rows each. A task that gathers them up to the usual megabyte
#: writes hundreds of files, one after the other.
SMALL_HOURS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}


def by_hour(rows: DataFrame) -> DataFrame:
    """Bring the rows of an hour together, so that it gets few files.

    A stream's rows nearly all belong to the current hour, and unreadable ones to none;
    adaptive execution splits such hours by size over several tasks, and joins small ones.
    """
    return rows.hint("rebalance", *PARTITIONS)


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """For queries that start inside: a query keeps the settings with which it was started."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def land(
    messages: DataFrame,
    kind: EventKind,
    lake: str,
    checkpoints: str,
    *,
    trigger: Mapping[str, object] = EVERY_30_SECONDS,
    gather_hours: bool = True,
) -> StreamingQuery:
    """Append the events of one kind to its table, by event date and hour.

    Late events go to the hour they belong to; nothing is dropped. One shuffle brings the rows
    of an hour together, so that a batch writes a file or two an hour; without
    ``gather_hours`` each task writes its own. The sink's list of files is never cut by age:
    that would lose rows which ``sources.lake.settle`` has not copied yet.
    """
    rows = lake_rows(messages, kind)
    if gather_hours:
        rows = by_hour(rows)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", table_path(lake, kind))
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{kind.table}")
        .partitionBy(*PARTITIONS)
        .outputMode("append")
        .trigger(**trigger)
    )
    with _settings(messages.sparkSession, SMALL_HOURS):
        return writer.start()


def quarantine(
    messages: DataFrame,
    kind: EventKind,
    rejects: str,
    checkpoints: str,
    *,
    trigger: Mapping[str, object] = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Keep the text of one kind's unreadable messages, with topic and arrival time.

    The lake keeps a row of them without their fields; here is what they were.
    """
    damaged = decode_with_rejects(messages, kind).where("is_rejected")
    kept = damaged.select(F.lit(kind.topic).alias("topic"), "kafka_timestamp", REJECTED)
    return (
        kept.writeStream.format("parquet")
        .option("path", f"{rejects.rstrip('/')}/{kind.table}")
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/rejected-{kind.table}")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def land_all(
    messages_of: Callable[[EventKind], DataFrame],
    lake: str,
    checkpoints: str,
    *,
    kinds: Iterable[EventKind] = KINDS,
    rejects: str | None = None,
    trigger: Mapping[str, object] = EVERY_30_SECONDS,
    **options: object,
) -> list[StreamingQuery]:
    """One independent query per kind, and one more for its rejects if a folder is given.

    ``messages_of`` gives each query its own source, so that it can subscribe to the one
    topic it needs instead of reading all of them. If one can't start, none is left running.
    """
    started: list[StreamingQuery] = []
    try:
        for kind in kinds:
            arriving = messages_of(kind)
            started.append(land(arriving, kind, lake, checkpoints, trigger=trigger, **options))
            if rejects:
                started.append(
                    quarantine(messages_of(kind), kind, rejects, checkpoints, trigger=trigger)
                )
    except BaseException:
        _stop(started)
        raise
    return started


def _stop(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def supervise(queries: Iterable[StreamingQuery]) -> None:
    """Block until any of the queries ends, stop the others, and raise what ended it.

    Looks at these queries only: the session may have seen others end before.
    """
    running = list(queries)
    try:
        while all(query.isActive for query in running):
            running[0].awaitTermination(timeout=1)
    finally:
        _stop(running)
    for query in running:
        if query.exception() is not None:
            raise query.exception()


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries that end by themselves, as with ``availableNow``.

    If one fails the others are stopped, not left running unattended.
    """
    waiting = list(queries)
    try:
        for query in waiting:
            query.awaitTermination()
    finally:
        _stop(waiting)


def rates(query: StreamingQuery) -> list[dict[str, object]]:
    """Rows and rows per second of the recent micro-batches."""
    return [
        {
            "batch_id": progress["batchId"],
            "rows": progress["numInputRows"],
            "rows_per_second": progress["processedRowsPerSecond"],
        }
        for progress in query.recentProgress
    ]
