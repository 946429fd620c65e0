"""What running queries report, kept as a table: rows, rates, backlog, and how they ended."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

STARTED, PROGRESS, ENDED = "started", "progress", "ended"
DDL = (
    "query_id string, run_id string, name string, event string, at timestamp, batch_id bigint, "
    "`rows` bigint, input_rows_per_second double, processed_rows_per_second double, "
    "duration_ms bigint, behind bigint, error string"
)


def _behind(sources) -> int | None:
    """Offsets not yet read, of the partition that is furthest behind; None if no source says."""
    found = [source.metrics.get("maxOffsetsBehindLatest") for source in sources if source.metrics]
    known = [int(float(value)) for value in found if value is not None]
    return max(known, default=None)


class ProgressLog(StreamingQueryListener):
    """Appends a row per start, micro-batch and ending of every query of the session."""

    def __init__(self, spark: SparkSession, path: str):
        # Writers of one folder would remove each other's unfinished files.
        self._spark, self._path = spark, f"{path.rstrip('/')}/writer={uuid4().hex}"
        self._writing = Lock()
        self._running: set[str] = set()

    def _keep(self, query_id, run_id, name, event, **facts) -> None:
        names = ("batch_id", "rows", "input", "processed", "took", "behind", "error")
        values = [facts.get(key) for key in names]
        at = self._spark.range(1).select(F.current_timestamp()).first()[0]
        row = (str(query_id), str(run_id), name, event, at, *values)
        kept = self._spark.createDataFrame([row], DDL)
        with self._writing:
            kept.coalesce(1).write.mode("append").parquet(self._path)

    def onQueryStarted(self, event) -> None:
        # Before anything is written: whoever has started a query can wait for its ending.
        self._running.add(str(event.runId))
        self._keep(event.id, event.runId, event.name, STARTED)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._keep(
            progress.id,
            progress.runId,
            progress.name,
            PROGRESS,
            batch_id=progress.batchId,
            rows=progress.numInputRows,
            input=progress.inputRowsPerSecond,
            processed=progress.processedRowsPerSecond,
            took=progress.durationMs.get("triggerExecution"),
            behind=_behind(progress.sources),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._keep(event.id, event.runId, None, ENDED, error=event.exception)
        self._running.discard(str(event.runId))

    def drain(self, seconds: float) -> None:
        """Wait until the endings of all queries that were started are written."""
        until = time.monotonic() + seconds
        while self._running:
            if time.monotonic() > until:
                raise TimeoutError(f"{len(self._running)} queries have not reported their end")
            time.sleep(0.1)


@contextmanager
def recorded(spark: SparkSession, path: str, seconds: float = 60) -> Iterator[ProgressLog]:
    """Record all queries that start inside, until the last of them has ended."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
        log.drain(seconds)
    finally:
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The reports of all writers to this folder."""
    return spark.read.schema(f"{DDL}, writer string").parquet(path).drop("writer")


def runs(progress: DataFrame) -> DataFrame:
    """A row per run of a query: its span, batches with rows, rows, backlog and error.

    ``ended_at`` is NULL for a run that never told its end: it is running, or its driver is gone.
    """
    is_batch = (F.col("event") == PROGRESS) & (F.col("rows") > 0)
    last = F.max_by("behind", F.when(F.col("behind").isNotNull(), F.col("at")))
    return progress.groupBy("query_id", "run_id").agg(
        F.min("at").alias("started_at"),
        F.max(F.when(F.col("event") == ENDED, F.col("at"))).alias("ended_at"),
        F.count_distinct(F.when(is_batch, F.col("batch_id"))).alias("batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max("duration_ms").alias("longest_ms"),
        last.alias("behind"),
        F.max("error").alias("error"),
    )
