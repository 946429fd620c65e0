"""Shards by an external shuffle in two passes, in DataFrame operations only.

The first pass scatters the records over buckets that fit in memory, by a seeded hash of their
keys. The second shuffles each bucket (Spark's ``shuffle`` is a Fisher-Yates over an array) and
lays the buckets end to end; a shard is a contiguous run of that order, so a bucket is written
straight into one or two shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from tallybrook.llm.common import settled, with_starts, without
from tallybrook.plans.workspace import fresh_folder

SHARDS = 40
SEED = 20231
BUCKET_BYTES = 8 << 20
BUCKETS_A_TASK = 4
#: Records of one key that fill more than this part of a bucket are spread over all of them.
KEYS_A_BUCKET = 8
COPIES_A_PIECE = 4096


def text_bytes(text: str = "text") -> Column:
    """Bytes of the text in UTF-8 and 16 for the record around it. NULL has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def _copies(counted: DataFrame, tasks: int) -> DataFrame:
    """A row for each of ``_n`` copies, numbered by ``_copy``; many copies come from many tasks."""
    last = F.col("_n") - 1
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor(last / COPIES_A_PIECE))))
    first = F.col("_piece") * COPIES_A_PIECE
    ends = F.least(last, first + COPIES_A_PIECE - 1)
    return (
        pieces.repartition(tasks, "_key", "_piece")
        .withColumn("_copy", F.explode(F.sequence(first, ends)))
        .drop("_n", "_piece")
    )


def shuffled(
    records: DataFrame,
    keys: Sequence[str],
    size: str,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> tuple[DataFrame, int]:
    """All columns of ``records`` and ``position``, gapless from 0 in random order; the count.

    Records with equal keys share a bucket as long as they fill an eighth of it at most; else
    each goes by its whole content and the number of its copy, so equal records spread over all
    buckets. Equal records are added up to get these numbers, never gathered. NULL keys count as
    a value. The order follows from the records, the seed and the bucket size alone, as every
    array is sorted before it is shuffled, buckets are taken in order and the number of tasks
    follows from the data. A single record larger than a bucket has one to itself and its
    neighbours; columns can't be maps.
    """
    whole = without(records, ())
    keyed = records.select(F.xxhash64(F.lit(seed), *keys).alias("_key"), *whole)
    sizes = settled(
        keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_sum")),
        "shuffle-sizes",
    )
    rows, total = sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_sum"), F.lit(0))
    ).first()
    buckets = max(1, -(-int(total) // bucket_bytes))
    tasks = -(-buckets // BUCKETS_A_TASK)

    def bucket(value: Column) -> Column:
        return F.pmod(value, F.lit(buckets)).alias("bucket")

    is_large = (F.col("_n") > 1) & (F.col("_sum") > bucket_bytes // KEYS_A_BUCKET)
    large = settled(sizes.where(is_large).select("_key"), "shuffle-large")
    record = F.struct(F.xxhash64(F.lit(seed + 1), *keys).alias("_key"), *whole).alias("record")
    counted = sizes.where(~is_large).groupBy(bucket(F.col("_key"))).agg(F.sum("_n").alias("n"))
    if large.isEmpty():
        scattered = keyed.select(bucket(F.col("_key")), record)
    else:
        small = keyed.join(large, "_key", "left_anti")
        equal = keyed.join(large, "_key", "left_semi").groupBy(*keyed.columns).agg(
            F.count(F.lit(1)).alias("_n")
        )
        salted = F.xxhash64(F.lit(seed + 2), *whole, "_copy")
        spread = _copies(equal, tasks).withColumn("bucket", bucket(salted))
        scattered = small.select(bucket(F.col("_key")), record).unionByName(
            spread.select("bucket", record)
        )
        more = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        counted = counted.unionByName(more).groupBy("bucket").agg(F.sum("n").alias("n"))
    # Neighbouring buckets share a task, as many in each.
    gathered = (
        scattered.withColumn("task", F.expr(f"bucket div {BUCKETS_A_TASK}").cast("int"))
        .repartitionById(tasks, "task")
        .groupBy("task", "bucket")
        .agg(F.sort_array(F.collect_list("record")).alias("records"))
        .sortWithinPartitions("bucket")
    )
    dealt = gathered.select("bucket", F.posexplode(F.shuffle("records", seed)))
    starts = with_starts(counted.withColumn("all", F.lit(0)), ["all"], "bucket", "n")
    # A start for each 8 MB; sent to the tasks, so that the records aren't shuffled once more.
    placed = dealt.join(F.broadcast(starts.select("bucket", "start")), "bucket")
    return (
        placed.select(
            *[F.col(f"col.`{name}`") for name in records.columns],
            (F.col("start") + F.col("pos")).alias("position"),
        ),
        rows,
    )


def in_shards(placed: DataFrame, rows: int, shards: int = SHARDS) -> DataFrame:
    """Adds ``shard`` and ``slot``: runs of ``position`` whose counts differ by one at most."""
    least, longer = divmod(rows, shards)
    edge = longer * (least + 1)
    at = F.col("position")
    short = max(least, 1)
    in_long = at < edge
    beyond = at - edge
    return placed.withColumns(
        {
            "shard": F.when(in_long, F.expr(f"position div {least + 1}"))
            .otherwise(longer + F.expr(f"(position - {edge}) div {short}"))
            .cast("int"),
            "slot": F.when(in_long, at % (least + 1)).otherwise(beyond % short).cast("long"),
        }
    )


def shard(
    records: DataFrame,
    keys: Sequence[str],
    size: str,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``records`` with ``shard`` and ``slot``; columns of those names are replaced.

    An empty table gives no rows. With fewer records than shards the last shards are empty.
    """
    own = records.select(*without(records, ("position", "shard", "slot")))
    placed, rows = shuffled(own, keys, size, seed, bucket_bytes)
    return in_shards(placed, rows, shards).drop("position")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; ``slot`` says the order inside it. Nothing is shuffled again."""
    sharded.write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document's shard by the law ``rows``, read back from the shards that were written.

    Whole texts are scattered, shuffled in their buckets and written; size and checksum are
    those of the written text. NULL texts stay NULL and have the checksum of an empty one; very
    long texts make their bucket larger, never a second record; repeated rows, NULL or equal ids
    are records of their own. No documents give no rows. Other columns are not written.
    """
    records = docs.select("doc_id", "text", text_bytes().alias("size"))
    path = fresh_folder(docs.sparkSession, "shards")
    write_shards(shard(records, ["doc_id", "text"], "size", shards).drop("size"), path)
    schema = docs.select("doc_id", "text").schema.add("slot", LongType()).add("shard", IntegerType())
    return docs.sparkSession.read.schema(schema).parquet(path).select(
        "doc_id",
        text_bytes().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
