"""Mixes sources to target weights along a low-discrepancy schedule.

Every source's documents are shuffled, laid end to end and cut into equal blocks of its own. The
mix is a row of slots, one block each. Slot i looks up a golden-ratio point in the cumulative
slots that the sources need for their targets and so gets its source; the n-th slot of a source
takes its n-th block, starting over when the source runs out. Any stretch of slots is close to
the weights.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import WORD, settled, with_starts, without

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = 4711
#: Tokens of a block at most.
BLOCK_TOKENS = 1024
#: Every source has this many blocks at least, if it has as many tokens.
LEAST_BLOCKS = 1024

#: The golden section in 31-bit fixed point: 2**31 / phi**3, odd, so no point comes twice in 2**31.
PERIOD = 1 << 31
STEP = 506_952_121

DOCS_A_BUCKET = 2_000
SLOTS_A_CHUNK = 16_384


def targets(sizes: list[int], weights: list[float], most: int = MOST_EPOCHS) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``most`` times its size.

    What a source can't take goes to the others by weight, until none is above.
    """
    share = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / weight > most * sizes[i]}
        if not full:
            for i in open_:
                share[i] = left * weights[i] / weight
            break
        for i in full:
            share[i] = float(most * sizes[i])
        left -= sum(share[i] for i in full)
        open_ -= full
    return share


def block_count(size: int, tokens: int = BLOCK_TOKENS) -> int:
    """Blocks of a source; their sizes differ by one token at most and none is above ``tokens``."""
    return max(1, -(-size // tokens), min(size, LEAST_BLOCKS))


def schedule(spark, shares: list[float], sizes: list[int], tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row per slot: ``slot``, ``source_no``, ``block``. Slots beyond MOST_EPOCHS take nothing.

    A source has as many slots as its blocks fill its share. Ranks within a source are counted
    chunk by chunk and then added up, so no task sees all slots of a source.
    """
    blocks = [block_count(size, tokens) for size in sizes]
    needed = [share * b / max(size, 1) for share, size, b in zip(shares, sizes, blocks)]
    slots = round(sum(needed))
    edges = [round(x / max(sum(needed), 1) * PERIOD) for x in accumulate(needed)]
    last = bisect_left(edges, edges[-1]) if edges else 0
    edges = edges[:last]

    point = (F.col("id") % PERIOD) * STEP % PERIOD
    owner = F.lit(0)
    if edges:
        bounds = F.array(*[F.lit(e).cast("long") for e in edges])
        owner = F.size(F.filter(bounds, lambda edge: edge <= F.col("_point")))
    drawn = (
        spark.range(slots)
        .withColumn("_point", point)
        .select(
            F.col("id").alias("slot"),
            owner.alias("source_no"),
            F.expr(f"id div {SLOTS_A_CHUNK}").alias("chunk"),
        )
    )
    per_chunk = drawn.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    starts = with_starts(per_chunk, ["source_no"], "chunk", "n").drop("n")
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = drawn.withColumn("_nth", F.row_number().over(inside) - 1).join(
        starts, ["source_no", "chunk"]
    )
    counts = F.array(*[F.lit(b).cast("long") for b in blocks] or [F.lit(1).cast("long")])
    rank = F.col("start") + F.col("_nth")
    own = F.element_at(counts, F.col("source_no") + 1)
    return ranked.select(
        "slot", "source_no", (rank % own).alias("block"), F.floor(rank / own).alias("epoch")
    ).where(F.col("epoch") < MOST_EPOCHS)


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def laid_out(docs: DataFrame, seed: int = SEED) -> tuple[DataFrame, list, list[int]]:
    """Documents with ``source_no`` and ``start``, their first word's place in their source.

    Takes doc_id, source, text and returns them without the text but with ``size`` and
    ``text_crc32``; then the sources by code point, NULL last, and their sizes. The source
    table has a row per source and is the only thing the driver sees.
    """
    spark = docs.sparkSession
    sized = settled(
        docs.select(
            "doc_id",
            "source",
            word_count().alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        ),
        "mix-sizes",
    )
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("docs"))
    rows = sorted(found.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    names, sizes = [r["source"] for r in rows], [r["n"] for r in rows]
    numbered = spark.createDataFrame(
        [(name, no) for no, name in enumerate(names)], "_name string, source_no int"
    )
    buckets = max(1, -(-sum(r["docs"] for r in rows) // DOCS_A_BUCKET))
    key = F.xxhash64(F.lit(seed), "doc_id", "text_crc32")
    keyed = (
        sized.join(numbered, sized["source"].eqNullSafe(numbered["_name"]))
        .drop("_name")
        .withColumn("_key", key)
        .withColumn("bucket", F.pmod("_key", F.lit(buckets)))
    )
    per_bucket = keyed.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
    starts = with_starts(per_bucket, ["source_no"], "bucket", "n").drop("n")
    inside = (
        Window.partitionBy("source_no", "bucket")
        .orderBy("_key", "doc_id", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = (
        keyed.withColumn("_local", local)
        .join(starts, ["source_no", "bucket"])
        .withColumn("start", F.col("start") + F.col("_local"))
        .drop("_local", "_key", "bucket")
    )
    return placed, names, sizes


def mix(docs: DataFrame, weights=WEIGHTS, seed: int = SEED) -> DataFrame:
    """A row per slot and document in it: the words ``from_word`` to ``to_word`` (exclusive).

    Documents that the mix doesn't reach, and those without words, keep one row whose slot is
    NULL. Also ``size``, ``source``, ``source_size``, ``target``, ``start`` and ``text_crc32``.
    NULL texts have no words; NULL is a source of its own; repeated rows are documents of their
    own; an empty table gives no rows. Columns besides doc_id, text and source are ignored.
    """
    spark = docs.sparkSession
    placed, names, sizes = laid_out(docs, seed)
    weight = [float(weights[i % len(weights)]) for i in range(len(names))]
    shares = targets(sizes, weight)
    blocks = [block_count(size) for size in sizes]
    facts = spark.createDataFrame(
        [
            (no, size, share, b, size // b, size % b)
            for no, (size, share, b) in enumerate(zip(sizes, shares, blocks))
        ],
        "source_no int, source_size long, target double, _blocks long, _least long, _rest long",
    )
    start, end = F.col("start"), F.col("start") + F.col("size")

    # Block k begins at word k * source_size div _blocks, so longer blocks are spread evenly.
    def block_at(word: str):
        past = f"CAST({word} + 1 AS DECIMAL(19, 0)) * CAST(_blocks AS DECIMAL(18, 0)) - 1"
        return F.expr(f"({past}) div source_size")

    def first_of(block: str):
        return F.expr(f"({block}) * _least + ({block}) * _rest div _blocks")

    words = F.sequence(block_at("start"), block_at("start + size - 1"))
    pieces = placed.join(facts, "source_no").withColumn(
        "block", F.explode_outer(F.when(F.col("size") > 0, words))
    )
    drawn = schedule(spark, shares, sizes)
    joined = pieces.join(drawn, ["source_no", "block"], "left")
    return joined.select(
        *without(placed, ("source_no",)),
        "source_size",
        "target",
        "slot",
        "epoch",
        F.greatest(start, first_of("block")).alias("_from"),
        F.least(end, first_of("block + 1")).alias("_to"),
    ).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "start",
        "source_size",
        "target",
        "slot",
        "epoch",
        (F.col("_from") - start).alias("from_word"),
        (F.col("_to") - start).alias("to_word"),
    )


def taken_words(docs: DataFrame, weights=WEIGHTS, seed: int = SEED) -> DataFrame:
    """Per document the words that the mix takes of it, repeats counted.

    Documents without words may share a place; ``copies`` of equal rows are told apart by it
    where they have words, and are given back one by one where they have none.
    """
    keys = ["doc_id", "source", "size", "text_crc32", "start", "source_size", "target"]
    words = F.when(F.col("slot").isNotNull(), F.col("to_word") - F.col("from_word")).otherwise(0)
    summed = (
        mix(docs, weights, seed)
        .groupBy(*keys)
        .agg(F.sum(words).cast("long").alias("taken"), F.count(F.lit(1)).alias("_rows"))
    )
    copies = F.when(F.col("size") == 0, F.col("_rows")).otherwise(1).cast("int")
    return summed.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select(
        *keys, "taken"
    )
