"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import settled


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi <> lo")
        .distinct()
    )


def _empty(frame: DataFrame) -> bool:
    return frame.head(1) == []


def components(edges: DataFrame) -> DataFrame:
    """``node`` and its ``component`` (the least node it reaches), but for those least nodes.

    ``edges`` has two longs ``a`` and ``b``. Each round hooks every node to its least smaller
    neighbour, shortens the chains by pointer jumping, and contracts the edges; every step is a
    sum or join on a key and written to the shared folder.
    """
    live = settled(_oriented(edges), "edges")
    labels = None
    while not _empty(live):
        hooks = settled(live.groupBy("hi").agg(F.min("lo").alias("up")), "hooks")
        while True:
            above = hooks.select(F.col("hi").alias("up"), F.col("up").alias("further"))
            jumped = hooks.join(above, "up", "left")
            moved = settled(
                jumped.select(
                    "hi",
                    F.coalesce("further", "up").alias("up"),
                    F.col("further").isNotNull().alias("moved"),
                ),
                "hooks",
            )
            hooks = moved.drop("moved")
            if _empty(moved.where("moved")):
                break
        renamed = hooks.select(F.col("hi").alias("component"), F.col("up").alias("_up"))
        found = hooks.select(F.col("hi").alias("node"), F.col("up").alias("component"))
        if labels is None:
            labels = found
        else:
            kept = labels.join(renamed, "component", "left").select(
                "node", F.coalesce("_up", "component").alias("component")
            )
            labels = settled(kept.unionByName(found), "labels")
        lower = hooks.select(F.col("hi").alias("lo"), F.col("up").alias("b"))
        contracted = (
            live.join(hooks, "hi")
            .join(lower, "lo", "left")
            .select(F.col("up").alias("a"), F.coalesce("b", "lo").alias("b"))
        )
        live = settled(_oriented(contracted), "edges")
    if labels is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return labels
