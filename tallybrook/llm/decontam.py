"""Benchmark passages in documents: a prefix-filtered set join, in DataFrame operations only.

An item's windows (``WINDOW`` consecutive words, or the whole of a shorter item) are sets of
shingles of ``SHINGLE`` words at known offsets. One pass over the documents finds where shingles
of any window occur. Ordered by how often they do, a window's rarest shingle is its prefix: to be
contained whole, a window needs that one. So only prefixes are joined with the places where they
occur; length and position say where the window would lie, and it counts if each of its shingles
is found there, word by word.

Places belong to a text, not to a document: equal texts are decided once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import settled

WINDOW = 10
SHINGLE = 3
#: Runs of anything but digits, a-z and what is beyond ASCII part words.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word before it is lower-cased.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: So many hashes of benchmark shingles at most are sent to every task at a time.
MOST_SENT = 1_000_000

TEXT = ["t1", "t2"]


def item_words(text: Column) -> Column:
    """The words of a text in order, A-Z in lower case; NULL has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    # Only the ends of a text can leave an empty word.
    return F.array_remove(F.split(lowered, GAPS), "")


def _joined(words: str, start: Column | str, length: Column | str) -> Column:
    """``length`` words from 0-based ``start``, parted by single spaces (which no word holds)."""
    return F.expr(f"array_join(slice({words}, int({start}) + 1, int({length})), ' ')")


def windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows: ``window`` (its words), ``length``, and the items they belong to.

    A NULL item_id is an item with an empty id. Items without words have no window.
    """
    items = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item"),
        item_words(benchmark["text"]).alias("words"),
    ).where(F.size("words") > 0)
    sized = items.withColumn("length", F.least(F.size("words"), F.lit(WINDOW)).cast("long"))
    started = sized.withColumn("at", F.explode(F.expr("sequence(0L, size(words) - length)")))
    return started.select(
        "item", "length", _joined("words", "at", "length").alias("window")
    ).distinct()


def window_shingles(found: DataFrame) -> DataFrame:
    """Each window's shingles: ``window``, ``length``, ``offset``, ``shingle``, ``width``."""
    words = found.select("window", "length").distinct().withColumn("words", F.split("window", " "))
    wide = words.withColumn("width", F.least("length", F.lit(SHINGLE)))
    placed = wide.withColumn("offset", F.explode(F.expr("sequence(0L, length - width)")))
    return placed.select(
        "window",
        "length",
        "offset",
        _joined("words", "offset", "width").alias("shingle"),
        "width",
    )


def _hashes(width: int) -> str:
    """Hashes of all shingles of ``words``, in place; ``_shingle_hash`` is their counterpart.

    The outer lambda names the words, lest they be split again for each place.
    """
    one = f"xxhash64({', '.join(f'w[i + {k}]' for k in range(width))})"
    every = f"transform(sequence(0, size(w) - {width}), i -> {one})"
    return f"transform(array(words), w -> IF(size(w) < {width}, array(), {every}))[0]"


def _shingle_hash(width: int) -> Column:
    parts = F.split("shingle", " ")
    return F.xxhash64(*[F.get(parts, F.lit(k)) for k in range(width)])


def places(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Where texts have shingles of the benchmark: text key, ``n_words``, ``at``, ``shingle``.

    Hashes of all places are looked up, then the words of those that are found. Every task holds
    up to ``MOST_SENT`` hashes; beyond that the documents are read once for each such part.
    """
    distinct = settled(shingles.select("shingle", "width").distinct(), "decontam-shingles")
    widths = sorted(
        (row["width"], row["n"])
        for row in distinct.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    texts = docs.select(
        F.xxhash64(F.lit(1), "text").alias("t1"),
        F.xxhash64(F.lit(2), "text").alias("t2"),
        item_words(docs["text"]).alias("words"),
    )
    found = None
    for width, count in widths:
        known = distinct.where(F.col("width") == width)
        hashes = known.select(_shingle_hash(width).alias("hash")).distinct()
        hashed = texts.withColumn("hashes", F.expr(_hashes(width)))
        # The outer form: else a filter is put before it that splits all texts once more.
        at_each = hashed.select(*TEXT, "words", F.posexplode_outer("hashes").alias("at", "hash"))
        parts = -(-count // MOST_SENT)
        for part in range(parts):
            bounded = hashes.where(F.pmod("hash", F.lit(parts)) == part)
            met = at_each.join(F.broadcast(bounded), "hash", "left_semi").select(
                *TEXT,
                F.size("words").cast("long").alias("n_words"),
                F.col("at").cast("long").alias("at"),
                _joined("words", "at", str(width)).alias("shingle"),
            )
            found = met if found is None else found.unionByName(met)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "t1 long, t2 long, n_words long, at long, shingle string"
        )
    exact = found.join(distinct.select("shingle"), "shingle", "left_semi")
    return exact.select(*TEXT, "n_words", "at", "shingle").distinct()


def occurrences(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every window that occurs: text key, ``start``, ``length``, ``window``; and all windows."""
    found = settled(windows(benchmark), "decontam-windows")
    shingles = settled(window_shingles(found), "decontam-shingles")
    where = settled(places(docs, shingles), "decontam-places")
    rarity = where.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    # A window with a shingle that never occurs can't occur itself.
    ranked = shingles.join(rarity, "shingle", "left")
    by_rarity = Window.partitionBy("window").orderBy(F.col("often").asc_nulls_first(), "offset")
    prefixes = (
        ranked.withColumn("_nth", F.row_number().over(by_rarity))
        .where("_nth = 1 AND often IS NOT NULL")
        .select("window", "length", "offset", "shingle")
    )
    candidates = (
        where.join(prefixes, "shingle")
        .select(*TEXT, "n_words", "window", "length", (F.col("at") - F.col("offset")).alias("start"))
        .where("start >= 0 AND start + length <= n_words")
    )
    needed = shingles.groupBy("window").agg(F.count(F.lit(1)).alias("needed"))
    spread = candidates.join(shingles.select("window", "offset", "shingle"), "window").select(
        *TEXT, "window", "length", "start", "shingle", (F.col("start") + F.col("offset")).alias("at")
    )
    held = spread.join(where.select(*TEXT, "at", "shingle"), [*TEXT, "at", "shingle"])
    counted = held.groupBy(*TEXT, "start", "length", "window").agg(F.count(F.lit(1)).alias("held"))
    whole = counted.join(needed, "window").where("held = needed")
    return whole.select(*TEXT, "start", "length", "window"), found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each document its words, those inside benchmark windows, and whose windows they are.

    NULL and empty texts have no words; repeated rows are documents of their own; an empty
    benchmark hits nothing and no documents give no rows; items that share an id are one item,
    and that without an id has an empty one. Very long texts take a row like others, and their
    hits are added up apart. Columns besides doc_id, text and item_id are ignored.
    """
    named = docs.select("doc_id", "text")
    found, all_windows = occurrences(named, benchmark.select("item_id", "text"))
    occurring = settled(found, "decontam-hits")
    hit = (
        occurring.select(*TEXT, "start", "length")
        .distinct()
        .select(*TEXT, F.explode(F.expr("sequence(start, start + length - 1)")).alias("at"))
        .distinct()
        .groupBy(*TEXT)
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items = (
        occurring.select(*TEXT, "window")
        .distinct()
        .join(all_windows.select("window", "item"), "window")
        .groupBy(*TEXT)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hits = hit.join(items, TEXT).select(
        F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "n_hit", "items"
    )
    counted = named.select(
        "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0)).cast("long").alias("n_words"),
        F.xxhash64(F.lit(1), "text").alias("_t1"),
        F.xxhash64(F.lit(2), "text").alias("_t2"),
    )
    joined = counted.join(settled(hits, "decontam-hits"), ["_t1", "_t2"], "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
