"""Sums of micro-batches in runs that are merged by tiers.

A batch writes a run of its own sums only. Every ``FANOUT`` batches their runs become one run of
the next tier, every ``FANOUT`` of those one of the tier above, and so on: what was summed once
is written again a few times in all, not with each batch, and the runs that make up everything
until a batch follow from its number alone. A repeated batch writes the same runs again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybrook.sources import folders

FANOUT = 16


def path(folder: str, tier: int, first: int) -> str:
    """The run of batches ``first`` to ``first + FANOUT ** tier - 1``."""
    return f"{folder}/tier={tier}/first={first}"


def cover(batch_id: int) -> list[tuple[int, int]]:
    """Tier and first batch of the runs that hold all batches up to this one."""
    runs, first, left, tier = [], 0, batch_id + 1, 0
    while FANOUT ** (tier + 1) <= left:
        tier += 1
    while left:
        width = FANOUT**tier
        runs += [(tier, first + i * width) for i in range(left // width)]
        first, left, tier = first + left // width * width, left % width, tier - 1
    return runs


def completed(batch_id: int) -> list[tuple[int, int]]:
    """The runs of higher tiers that end with this batch, lowest first."""
    runs, tier = [], 1
    while (batch_id + 1) % FANOUT**tier == 0:
        runs.append((tier, batch_id + 1 - FANOUT**tier))
        tier += 1
    return runs


def _inputs(folder: str, tier: int, first: int) -> list[str]:
    width = FANOUT ** (tier - 1)
    return [path(folder, tier - 1, first + i * width) for i in range(FANOUT)]


def _read(spark: SparkSession, folder: str, runs: list[str], schema: str) -> DataFrame:
    read = spark.read.schema(schema).option("basePath", folder).parquet(*runs)
    return read.drop("tier", "first")


def add(
    own: DataFrame,
    folder: str,
    batch_id: int,
    schema: str,
    add_up: Callable[[DataFrame], DataFrame],
    partitions: tuple[str, ...] = (),
) -> None:
    """Write a batch's sums, and the runs that it completes.

    The runs that one of them replaced are removed with the next one of its tier: until then,
    for ``FANOUT`` batches at least, readers of earlier batches can finish.
    """
    spark = own.sparkSession
    own.write.mode("overwrite").partitionBy(*partitions).parquet(path(folder, 0, batch_id))
    for tier, first in completed(batch_id):
        parts = _read(spark, folder, _inputs(folder, tier, first), schema)
        merged = add_up(parts).write.mode("overwrite").partitionBy(*partitions)
        merged.parquet(path(folder, tier, first))
        before = first - FANOUT**tier
        if before >= 0:
            folders.remove(spark, _inputs(folder, tier, before))


def read(spark: SparkSession, folder: str, batch_id: int, schema: str) -> DataFrame:
    """The sums of all batches up to this one, still to be added up: one scan of few runs."""
    runs = [path(folder, tier, first) for tier, first in cover(batch_id)]
    return _read(spark, folder, runs, schema)


def read_own(spark: SparkSession, folder: str, batch_id: int, schema: str) -> DataFrame:
    """The sums of one batch, while it is the newest."""
    return _read(spark, folder, [path(folder, 0, batch_id)], schema)
