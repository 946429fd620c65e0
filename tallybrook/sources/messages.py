"""Message logs: a topic-based broker, or files with the same four columns.

Only the format and the options differ, so everything downstream is tested with files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallybrook.operators.decode import envelope
from tallybrook.schemas import MESSAGE_FIELDS, POSITION_FIELDS, TOPICS, ddl

KAFKA = "kafka"

# How often a live view looks. A limit to what it takes each time is an option;
# a topic that is busier than such a limit falls behind for good.
POLL_SECONDS = 3


def kafka_source_options(
    servers: str,
    topics: Iterable[str] = TOPICS,
    *,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    max_per_task: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Subscribe to the topics.

    ``starting`` holds for the first start only; later ones follow the checkpoint. Lost
    offsets are skipped unless ``fail_on_data_loss``. ``max_per_trigger`` bounds a micro-batch,
    if given; the rest comes with the next ones. ``max_per_task`` splits a broker partition that holds a busy user's events
    over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if max_per_task is not None:
        options["maxRecordsPerPartition"] = str(max_per_task)
    return options


def kafka_sink_options(servers: str) -> dict[str, str]:
    """Durable publishing: all replicas confirm, three retries, small batches."""
    # Fixed values.
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "10",
        "kafka.batch.size": "16384",
    }


def _load(
    reader, fmt: str, options: Mapping[str, str], path: str | None, positions: bool
) -> DataFrame:
    configured = reader.format(fmt).options(**options)
    if fmt != KAFKA:
        also = POSITION_FIELDS if positions else {}
        configured = configured.schema(ddl({**MESSAGE_FIELDS, **also}))
    return envelope(configured.load(path) if path else configured.load(), positions)


def stream_messages(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] = {},
    path: str | None = None,
    positions: bool = False,
) -> DataFrame:
    """Messages as they arrive; with ``positions`` also their partition and offset."""
    return _load(spark.readStream, fmt, options, path, positions)


def batch_messages(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] = {},
    path: str | None = None,
    positions: bool = False,
) -> DataFrame:
    """The log as it is now. A broker needs ``starting="earliest"`` here."""
    return _load(spark.read, fmt, options, path, positions)
