"""Document fingerprints by winnowing.

Every run of ``K`` code points has a rolling hash. Of every ``WINDOW`` consecutive hashes the
least is kept, the rightmost of equal ones, with its position. So two texts that share
``K + WINDOW - 1`` code points in a row share a kept hash, and no match shorter than ``K`` counts.
Short texts have narrower windows, so that two thirds of a text in a row share a hash with it if
they are ``K`` code points; what a wide window keeps, a narrow one keeps too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import settled, shipped

K = 12
#: Hashes of a window at most.
WINDOW = 16
ROWS_A_RANGE = 2000
MOST_RANGES = 1 << 16
MOST_LONG = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64((1 << 32) - 1)
_HALF = np.uint64(32)


@lru_cache(maxsize=8)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    with np.errstate(over="ignore"):
        both = []
        for root in (_BASE, _INVERSE):
            steps = np.full(length, np.uint64(root))
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def _least_of_windows(values: np.ndarray, window: int) -> np.ndarray:
    """Minimum of each ``window`` consecutive values, in time that doesn't depend on it."""
    if len(values) <= window:
        return values.min(keepdims=True)
    count = len(values) - window + 1
    padded = np.full(-(-len(values) // window) * window, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[window - 1 : window - 1 + count])


def window_of(length: int, k: int = K) -> int:
    """Window of a text: two thirds of it in a row have as many hashes, unless it is ``WINDOW``."""
    return max(1, min(WINDOW, length - length // 3 - k + 1))


def winnow(text: str, k: int = K, window: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes (32 bits) and their positions, in order of position.

    A text shorter than ``k`` is one run; an empty text keeps nothing. Without a ``window`` the
    text's length gives it.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    length = len(codes)
    if not length:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    k = min(k, length)
    window = window or window_of(length, k)
    powers, inverses = _powers(1 << max(length, 1024).bit_length())
    sums = np.zeros(length + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:length], out=sums[1:])
    hashes = (sums[k:] - sums[:-k]) * inverses[: length - k + 1]
    hashes ^= hashes >> _HALF
    hashes *= _MIX
    # The position counts down in the low half: the least value is the rightmost of equal hashes.
    down = _LOW - np.arange(len(hashes), dtype=np.uint64)
    least = _least_of_windows((hashes & ~_LOW) | down, window)
    kept = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return kept >> _HALF, (_LOW - (kept & _LOW)).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two texts' kept hashes; two empty texts are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def as_text(values: np.ndarray) -> str:
    """Eight hexadecimal digits a hash or position, in order of position."""
    return values.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, k: int = K, window: int | None = None) -> DataFrame:
    """doc_id, ``hashes`` and ``positions`` of every whole text; NULL counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [winnow(text or "", k, window) for text in batch["text"].to_pylist()]
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "hashes": pa.array([h.astype(np.int64) for h, _ in kept], pa.list_(pa.int64())),
                    "positions": pa.array([p for _, p in kept], pa.list_(pa.int64())),
                }
            )

    named = docs.select("doc_id", "text")
    kind = named.schema["doc_id"].dataType.simpleString()
    return named.transform(shipped).mapInArrow(run, f"doc_id {kind}, hashes array<long>, positions array<long>")


def _range_no(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``, in two steps of their root."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    firsts = F.array(*[F.lit(part[0]).cast("long") for part in parts])
    inner = F.array(*[F.array(*[F.lit(b).cast("long") for b in part]) for part in parts])
    part = F.size(F.filter(firsts, lambda x: x <= value))
    rest = F.size(F.filter(F.get(inner, part - 1), lambda x: x <= value))
    return F.when(part == 0, 0).otherwise((part - 1) * step + rest)


def _parts_of_large(large: DataFrame, rows: int, rows_a_range: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ids with more than a range each, cut by text; and what follows each part but the last.

    ``part`` grows with the text inside a range. Equal rows are spread over parts by a number of
    their own, given where they are read.
    """
    numbered = large.withColumn("_number", F.monotonically_increasing_id())
    parts = -(-rows // rows_a_range)
    cut = settled(
        numbered.repartitionByRange(parts, "range_no", "text", "_number").select(
            "doc_id", "text", "range_no", "extra", F.spark_partition_id().alias("part")
        ),
        "large-ids",
    )
    firsts = cut.groupBy("range_no", "part", "doc_id").agg(F.min("text").alias("_first"))
    after = F.lead("_first").over(Window.partitionBy("range_no").orderBy("part"))
    follows = firsts.select(
        "doc_id", after.alias("text"), "range_no", F.lit(1).alias("extra"), "part"
    )
    return cut, settled(follows, "large-follows")


def with_next(docs: DataFrame, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """Documents in ranges of descending doc_id, each range followed by the next one's first.

    ``range_no`` and ``extra`` (1 for the row that only follows) say so; the rows of a range are
    in one partition of their own, in order. Each text is shuffled once. NULL ids come last,
    equal ids go by text. An id (or NULL) with more rows than a range has ranges of its own, cut
    by text, equal rows too; its texts are written once more. The first document follows the
    last. Ranges are few and known to the driver.
    """
    spark = docs.sparkSession
    named = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ids = named.select("doc_id")
    rows = ids.count()
    ranges = max(1, min(MOST_RANGES, -(-rows // rows_a_range)))
    # At least rows / MOST_RANGES, so there are no more such ids than ranges.
    most = max(rows_a_range, -(-rows // ranges))
    repeated = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    large = {row["doc_id"]: row["n"] for row in repeated.collect()}
    bounds: set[int] = set()
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * ranges))).first()[0]
        bounds.update(cuts or ())
    # A large id is alone in its range.
    known = [i for i in large if i is not None]
    edges = sorted(bounds | set(known) | {i + 1 for i in known if i < MOST_LONG})
    low = _range_no(F.col("doc_id"), edges)
    last = len(edges) + 1
    ranged = F.when(F.col("doc_id").isNull(), last).otherwise(len(edges) - low).cast("int")
    placed = named.select("doc_id", "text", ranged.alias("range_no"), F.lit(0).alias("extra"))

    firsts = ids.select("doc_id", ranged.alias("range_no")).groupBy("range_no")
    found = sorted(
        (row["range_no"], row["first"])
        for row in firsts.agg(F.max("doc_id").alias("first")).collect()
    )
    before = [found[-1][0], *[no for no, _ in found[:-1]]] if found else []
    targets = spark.createDataFrame(
        [(first, no) for no, (_, first) in zip(before, found)], "_first long, range_no int"
    )
    heads = named.join(F.broadcast(targets), named["doc_id"].eqNullSafe(targets["_first"]))
    extra = heads.groupBy("doc_id", "range_no").agg(F.min("text").alias("text"))
    followed = placed.unionByName(extra.withColumn("extra", F.lit(1)))
    partitions = last + 1
    if large:
        numbers = [no for no, first in found if first in large]
        is_large = F.col("range_no").isin(numbers)
        total = sum(large.values())
        cut, follows = _parts_of_large(placed.where(is_large), total, rows_a_range)
        # What follows a large id as a whole follows its last part.
        ends = follows.where(F.col("text").isNull()).select("range_no", "part")
        tails = extra.withColumn("extra", F.lit(1)).join(ends, "range_no")
        parts = cut.unionByName(follows.where(F.col("text").isNotNull())).unionByName(tails)
        width = -(-total // rows_a_range)
        own = {no: at for at, no in enumerate(numbers)}
        offset = F.create_map(*[F.lit(v) for pair in own.items() for v in pair])
        numbered = parts.withColumn(
            "range_no", (last + 1 + offset[F.col("range_no")] + F.col("part")).cast("int")
        ).drop("part")
        followed = followed.where(~is_large).unionByName(numbered)
        partitions += width + len(numbers)
    return followed.repartitionById(partitions, "range_no").sortWithinPartitions(
        "range_no", "extra", F.desc_nulls_last("doc_id"), "text"
    )


def edited_likeness(docs: DataFrame, k: int = K, window: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike they and the next one's are.

    In the edited text the last third is replaced by the beginning of the next document (see
    ``with_next``). Fingerprints come as text of hexadecimal hashes, and ``positions`` say in the same way where
    in the text each of them begins. NULL counts as empty, whose
    fingerprint is empty; repeated rows are documents of their own; an empty table gives no
    rows; columns besides doc_id and text are ignored.
    """
    names = (
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next", "n_prints", "positions",
    )
    types = (
        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
        pa.float64(), pa.float64(), pa.int64(), pa.string(),
    )
    schema = pa.schema(list(zip(names, types)))

    def compared(doc_id, text: str, kept: tuple, following: str, theirs: np.ndarray) -> tuple:
        own, positions = kept
        moved = len(text) // 3
        edited = text[: len(text) - moved] + following[:moved]
        changed = winnow(edited, k, window)[0]
        return (
            doc_id,
            len(text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            as_text(own),
            as_text(changed),
            likeness(own, changed),
            likeness(own, theirs),
            len(own),
            as_text(positions),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out = []
            columns = [batch[name].to_pylist() for name in ("range_no", "extra", "doc_id", "text")]
            for no, extra, doc_id, text in zip(*columns):
                open_ = waiting is not None and waiting[0] == no
                if extra and not open_:
                    continue
                prints = winnow(text, k, window)
                if open_:
                    out.append(compared(*waiting[1:], text, prints[0]))
                waiting = None if extra else (no, doc_id, text, prints)
            values = list(zip(*out)) or [[] for _ in names]
            arrays = [pa.array(v, t) for v, t in zip(values, types)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return with_next(docs).transform(shipped).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double, n_prints long,"
        " positions string",
    )
