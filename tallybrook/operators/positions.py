"""What is missing in a log, by partition and offset.

A source that tolerates lost offsets goes on after them in silence. Here the offsets that were
read are kept as bitmaps, 64 to a number, added up in each task; repeated messages change nothing.
Where a run of offsets begins and ends follows from a bitmap and its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDTH = 64
PARTITION = ("topic", "partition")


def offset_words(positions: DataFrame) -> DataFrame:
    """topic, partition, word, bits, messages: which of 64 offsets there are, and how many rows.

    Messages without an offset are of no partition's sequence and left out.
    """
    bit = F.expr(f"shiftleft(1L, cast(offset % {WIDTH} AS int))")
    known = positions.where(F.col("offset") >= 0)
    return known.groupBy(*PARTITION, F.expr(f"offset div {WIDTH}").alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("messages")
    )


def offset_coverage(positions: DataFrame) -> DataFrame:
    """Per partition the first and last offset, how many there are, are missing, came again."""
    words = offset_words(positions)
    low = F.expr(f"word * {WIDTH} + length(substring_index(reverse(bin(bits)), '1', 1))")
    high = F.expr(f"word * {WIDTH} + length(bin(bits)) - 1")
    found = words.groupBy(*PARTITION).agg(
        F.min(low).alias("first_offset"),
        F.max(high).alias("last_offset"),
        F.sum(F.bit_count("bits")).cast("long").alias("present"),
        F.sum("messages").alias("messages"),
    )
    span = F.col("last_offset") - F.col("first_offset") + 1
    return found.select(
        *PARTITION,
        "first_offset",
        "last_offset",
        "present",
        (span - F.col("present")).alias("missing"),
        (F.col("messages") - F.col("present")).alias("repeated"),
    )


def offset_gaps(positions: DataFrame) -> DataFrame:
    """Each gap between offsets that were read: topic, partition, first_missing, last_missing, missing."""
    words = offset_words(positions).drop("messages")
    same = [*PARTITION, "word"]
    before = words.select(*PARTITION, (F.col("word") + 1).alias("word"), F.col("bits").alias("below"))
    after = words.select(*PARTITION, (F.col("word") - 1).alias("word"), F.col("bits").alias("above"))
    met = words.join(before, same, "left").join(after, same, "left").fillna(0, ["below", "above"])
    top = WIDTH - 1
    edges = met.select(
        *same,
        F.expr(f"bits & ~(shiftleft(bits, 1) | shiftrightunsigned(below, {top}))").alias("starts"),
        F.expr(f"bits & ~(shiftrightunsigned(bits, 1) | shiftleft(above, {top}))").alias("ends"),
    )
    sides = F.array(
        F.struct(F.lit(False).alias("is_end"), F.col("starts").alias("bits")),
        F.struct(F.lit(True).alias("is_end"), F.col("ends").alias("bits")),
    )
    each = edges.select(*same, F.explode(sides).alias("side"))
    places = F.expr(f"filter(sequence(0, {top}), i -> getbit(side.bits, i) = 1)")
    at = each.select(*same, "side.is_end", F.explode(places).alias("i")).select(
        *PARTITION, "is_end", (F.col("word") * WIDTH + F.col("i")).alias("offset")
    )
    # Ends and starts alternate; what comes before a start is the end of the run before.
    in_order = Window.partitionBy(*PARTITION).orderBy("offset", "is_end")
    ended = at.withColumn("ended", F.lag("offset").over(in_order))
    return ended.where(~F.col("is_end") & F.col("ended").isNotNull()).select(
        *PARTITION,
        (F.col("ended") + 1).alias("first_missing"),
        (F.col("offset") - 1).alias("last_missing"),
        (F.col("offset") - F.col("ended") - 1).alias("missing"),
    )
