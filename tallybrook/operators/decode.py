"""From keyed JSON messages to typed rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.schemas import POSITION_FIELDS, EventKind, ddl

REJECTED = "rejected_json"


def computed(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row, however often it is used.

    Spark moves a filter below the columns that it asks for, parsing and all, and so repeats
    them; it moves none below a generator.
    """
    return frame.withColumn(name, F.explode(F.array(value)))


def envelope(raw: DataFrame, positions: bool = False) -> DataFrame:
    """Name the parts of a source message; key and value become text.

    With ``positions`` it keeps the message's partition and offset.
    """
    return raw.select(
        F.col("key").cast("string").alias("user_id_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic"),
        F.col("timestamp").alias("kafka_timestamp"),
        *(POSITION_FIELDS if positions else ()),
    )


def route(messages: DataFrame, *kinds: EventKind) -> DataFrame:
    """Messages that travelled on the topics of the given kinds."""
    return messages.where(F.col("topic").isin(*[kind.topic for kind in kinds]))


def parse(messages: DataFrame, fields: Mapping[str, str], *carry: str | Column) -> DataFrame:
    """One column per payload field, then the carried message columns.

    The row is always kept. A message that is no JSON object has only NULL fields; a field
    of the wrong type is NULL alone. Name only the fields a query needs: the parser skips
    the others.
    """
    parsed = F.from_json("raw_json", ddl(fields)).alias("payload")
    kept = messages.select(parsed, *(carry or ("kafka_timestamp",)))
    return kept.select("payload.*", *[name for name in kept.columns if name != "payload"])


def decode(messages: DataFrame, kind: EventKind) -> DataFrame:
    """Rows of one kind: its payload fields and the arrival time."""
    return parse(route(messages, kind), kind.fields)


def decode_with_rejects(messages: DataFrame, kind: EventKind) -> DataFrame:
    """``decode`` plus what to quarantine.

    ``is_rejected`` marks messages that are no JSON object or have a field of the wrong
    type; ``rejected_json`` holds their text.
    """
    schema = ddl({**kind.fields, REJECTED: "string"})
    parsed = F.from_json("raw_json", schema, {"columnNameOfCorruptRecord": REJECTED})
    # Readers filter by ``is_rejected``; that must not parse, and make the message, once more.
    kept = computed(route(messages, kind).select("raw_json", "kafka_timestamp"), "payload", parsed)
    # NULL and empty text give a NULL payload, which cannot hold its own text.
    no_object = F.col("payload").isNull()
    text = F.when(no_object, F.col("raw_json")).otherwise(F.col(f"payload.{REJECTED}"))
    return kept.select(
        *[F.col(f"payload.`{name}`") for name in kind.fields],
        "kafka_timestamp",
        (no_object | F.col(f"payload.{REJECTED}").isNotNull()).alias("is_rejected"),
        text.alias(REJECTED),
    )
