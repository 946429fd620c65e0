"""What several operators share: tables, folds, words and offsets."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.plans.workspace import fresh_folder

#: A word, as Java's and DuckDB's regular expressions write it.
WORD = r"[^\x20\x09-\x0D]+"

#: Lower-cases A-Z only, on UTF-8 bytes.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``. A NULL id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def words(text: str | None) -> list[bytes]:
    """A text's words, A-Z lower-cased. ``bytes.split`` cuts at 0x20 and 0x09 to 0x0D."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


_SHIPPED: set[str] = set()


def shipped(frame: DataFrame) -> DataFrame:
    """The same frame, after this package was sent to the executors, once an application.

    Python workers import it there, wherever the driver was started.
    """
    context = frame.sparkSession.sparkContext
    package = Path(__file__).resolve().parents[1]
    if context.applicationId not in _SHIPPED and package.is_dir():
        target = f"{tempfile.mkdtemp(prefix='package-')}/{package.name}"
        context.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)
    return frame


def settled(frame: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, safe from lost executors."""
    path = fresh_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def without(frame: DataFrame, names: Sequence[str]) -> list[Column]:
    """The columns whose names, in any case, are none of these."""
    taken = {name.lower() for name in names}
    return [frame[f"`{name}`"] for name in frame.columns if name.lower() not in taken]


def with_starts(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, width: int = 1024
) -> DataFrame:
    """Adds ``start``: the sum of ``value`` over smaller ``order`` within ``keys``.

    ``rows`` has one row per key and order, and no NULL in either. Two levels, so that no
    task holds all rows of one key: sums of ``width`` neighbours first, then inside them.
    """
    ranged = rows.withColumn("_range", F.expr(f"`{order}` div {width}"))
    before = (Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
    across = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*before)
    bases = sums.select(
        *keys, "_range", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(*before)
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(bases, [*keys, "_range"])
    return joined.withColumn("start", F.col("_base") + F.col("_local")).drop(
        "_range", "_base", "_local"
    )
