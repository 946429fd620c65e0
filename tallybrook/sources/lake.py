"""Reading the lake tables, and settling what a stream has written.

A stream commits its batches to a log of files. ``settle`` copies the files that no earlier run
has copied into a part of few large files, and then names all parts in a new snapshot. Readers take
the parts of the newest snapshot and the files that it doesn't cover: what is read is decided by
committed batches and files alone, never by a clock.

Parts are merged by levels: ``FANOUT`` parts of a level become one of the next, so a table of n
settlings has a few times log n parts, and a row is rewritten log n times. Below
``<lake>/settled/<table>``:

    parts/part=<id>/date=../hour=..   rows
    files/part=<id>                   the part's files: rows, first and last ``ingest_ts``
    covered/part=<id>                 the sink's files that the part holds, with their batches
    snapshots/version=<n>             the parts that make the table
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybrook.schemas import PARTITION_FIELDS, EventKind, ddl
from tallybrook.sources import folders

FANOUT = 8
#: Files of settled parts are cut at about this size; a task writes so many of them at most.
FILE_BYTES = 128 << 20
FILES_A_TASK = 16

PART_DDL = (
    "part string, level int, first_batch bigint, last_batch bigint, rows bigint,"
    " first_ingest timestamp, last_ingest timestamp, live boolean, parts int"
)
FILE_DDL = "path string, size bigint, rows bigint, first_ingest timestamp, last_ingest timestamp"
COVERED_DDL = "path string, size bigint, batch bigint"


@dataclass(frozen=True)
class Part:
    part: str
    level: int
    first_batch: int
    last_batch: int
    rows: int
    first_ingest: datetime | None
    last_ingest: datetime | None
    #: The sink's files that it holds are still there.
    live: bool


@dataclass(frozen=True)
class Snapshot:
    version: int
    parts: tuple[Part, ...]

    @property
    def last_batch(self) -> int | None:
        return max((part.last_batch for part in self.parts), default=None)


def table_path(lake: str, kind: EventKind) -> str:
    return f"{lake.rstrip('/')}/{kind.table}"


def _base(lake: str, kind: EventKind) -> str:
    return f"{lake.rstrip('/')}/settled/{kind.table}"


def _live(spark: SparkSession, lake: str, kind: EventKind) -> DataFrame:
    return spark.read.schema(ddl(kind.lake_fields)).parquet(table_path(lake, kind))


def _versions(spark: SparkSession, lake: str, kind: EventKind) -> list[int]:
    found = folders.names(spark, f"{_base(lake, kind)}/snapshots")
    return sorted(int(name.removeprefix("version=")) for name in found if name.startswith("version="))


def _read_version(spark: SparkSession, lake: str, kind: EventKind, version: int) -> Snapshot | None:
    path = f"{_base(lake, kind)}/snapshots/version={version}"
    rows = spark.read.schema(PART_DDL).parquet(path).collect()
    # A version whose writer died has no rows, or not all.
    if not rows or rows[0]["parts"] != len(rows):
        return None
    parts = [Part(*[row[name] for name in Part.__dataclass_fields__]) for row in rows]
    return Snapshot(version, tuple(sorted(parts, key=lambda part: (part.first_batch, part.part))))


def snapshot(spark: SparkSession, lake: str, kind: EventKind) -> Snapshot:
    """The newest whole snapshot; version 0 without parts before the first one."""
    for version in reversed(_versions(spark, lake, kind)):
        found = _read_version(spark, lake, kind, version)
        if found:
            return found
    return Snapshot(0, ())


def sink_files(spark: SparkSession, lake: str, kind: EventKind) -> DataFrame:
    """The files that the stream has committed: path, size, batch.

    The sink's log has a file per batch; every few batches one sums up all before it, whose
    files' batches are then known as that number at most. Spark's file sources skip the log's
    folder for its name, so its lines are read as such.
    """
    log = f"{table_path(lake, kind)}/_spark_metadata"
    found = [name.partition(".") for name in folders.names(spark, log) if name[0].isdigit()]
    summary = max((int(batch) for batch, _, rest in found if rest == "compact"), default=-1)
    files = [(int(batch), rest) for batch, _, rest in found if int(batch) >= summary]
    entries = spark.createDataFrame([], f"{COVERED_DDL}, action string")
    for batch, rest in sorted(files):
        if batch > summary or rest:
            lines = spark.sparkContext.textFile(f"{log}/{batch}{'.' + rest if rest else ''}")
            read = spark.read.schema("path string, size bigint, action string").json(lines)
            entries = entries.unionByName(read.withColumn("batch", F.lit(batch).cast("long")))
    # The first line of each file is a format version and no entry.
    return entries.where("action = 'add'").drop("action")


def _of_parts(spark: SparkSession, base: str, what: str, schema: str, parts: Iterable[Part]) -> DataFrame:
    """One scan over the given parts' folders."""
    paths = [f"{base}/{what}/part={part.part}" for part in parts]
    if not paths:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(f"{schema}, part string").option("basePath", f"{base}/{what}")
    return read.parquet(*paths).drop("part")


def uncovered(spark: SparkSession, lake: str, kind: EventKind, shot: Snapshot) -> DataFrame:
    """The sink's files that no part of the snapshot holds: path, size, batch."""
    covered = _of_parts(spark, _base(lake, kind), "covered", COVERED_DDL, shot.parts)
    return sink_files(spark, lake, kind).join(covered.select("path"), "path", "left_anti")


def _open_files(spark: SparkSession, root: str, schema: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def tail(spark: SparkSession, lake: str, kind: EventKind, shot: Snapshot) -> DataFrame:
    """Rows of committed files that the snapshot doesn't cover; no other file is opened."""
    paths = [row["path"] for row in uncovered(spark, lake, kind, shot).select("path").collect()]
    return _open_files(spark, table_path(lake, kind), ddl(kind.lake_fields), sorted(paths))


def settled(
    spark: SparkSession,
    lake: str,
    kind: EventKind,
    arrived_from: datetime | None = None,
    arrived_before: datetime | None = None,
) -> DataFrame:
    """The rows of the newest snapshot, by the directories of its parts alone.

    With a span of ``ingest_ts``, only files whose rows may be in it are opened.
    """
    return _settled(spark, lake, kind, snapshot(spark, lake, kind), arrived_from, arrived_before)


def _settled(
    spark: SparkSession,
    lake: str,
    kind: EventKind,
    shot: Snapshot,
    arrived_from: datetime | None,
    arrived_before: datetime | None,
) -> DataFrame:
    schema, base = ddl(kind.lake_fields), _base(lake, kind)
    if arrived_from is None and arrived_before is None:
        return _of_parts(spark, base, "parts", schema, shot.parts)

    def overlaps(first: object, last: object):
        checks = []
        if arrived_from is not None:
            checks.append(last >= arrived_from)
        if arrived_before is not None:
            checks.append(first < arrived_before)
        return checks

    files = _of_parts(spark, base, "files", FILE_DDL, shot.parts)
    for check in overlaps(F.col("first_ingest"), F.col("last_ingest")):
        files = files.where(check)
    paths = sorted(row["path"] for row in files.select("path").collect())
    rows = _open_files(spark, f"{base}/parts", f"{schema}, part string", paths)
    return _in_span(rows.drop("part"), arrived_from, arrived_before)


def _in_span(rows: DataFrame, arrived_from: datetime | None, arrived_before: datetime | None) -> DataFrame:
    if arrived_from is not None:
        rows = rows.where(F.col("ingest_ts") >= F.lit(arrived_from))
    if arrived_before is not None:
        rows = rows.where(F.col("ingest_ts") < F.lit(arrived_before))
    return rows


def read_lake(
    spark: SparkSession,
    lake: str,
    kind: EventKind,
    arrived_from: datetime | None = None,
    arrived_before: datetime | None = None,
) -> DataFrame:
    """One lake table. Filters on ``date`` and ``hour`` skip whole directories.

    Every committed row comes once, whatever clocks its batch was stamped by. The schema is
    given, so no file is opened to find it; ``date`` and ``hour`` come last. A span of
    ``ingest_ts`` opens only those settled files that have rows of it.
    """
    shot = snapshot(spark, lake, kind)
    if not shot.parts:
        return _in_span(_live(spark, lake, kind), arrived_from, arrived_before)
    rest = _in_span(tail(spark, lake, kind, shot), arrived_from, arrived_before)
    return _settled(spark, lake, kind, shot, arrived_from, arrived_before).unionByName(rest)


def _gathered(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows by hour, a task for up to ``FILES_A_TASK`` files; a large hour in several files.

    ``files`` (path, size) says how large the hours are.
    """
    day, hour = (F.regexp_extract("path", f"/{name}=([^/]+)/", 1) for name in PARTITION_FIELDS)
    pieces = F.ceil(F.sum("size") / FILE_BYTES).cast("long")
    hours = files.groupBy(
        day.try_cast("date").alias("_date"), hour.try_cast("int").alias("_hour")
    ).agg(F.greatest(pieces, F.lit(1).cast("long")).alias("_pieces"))
    total = hours.agg(F.sum("_pieces").alias("n")).first()["n"] or 0
    same = rows["date"].eqNullSafe(hours["_date"]) & rows["hour"].eqNullSafe(hours["_hour"])
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = numbered.join(hours, same).withColumn("_piece", F.pmod("_row", "_pieces"))
    tasks = max(1, -(-total // FILES_A_TASK))
    return placed.repartition(tasks, *PARTITION_FIELDS, "_piece").drop(
        "_date", "_hour", "_pieces", "_piece", "_row"
    )


def _write_part(
    spark: SparkSession,
    lake: str,
    kind: EventKind,
    rows: DataFrame,
    files: DataFrame,
    covered: DataFrame,
    level: int,
    live: bool = True,
) -> Part:
    """Rows, file bounds and covered files of a new part, which nobody reads yet."""
    base = _base(lake, kind)
    part = f"{level}-{uuid4().hex}"
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    gathered = _gathered(counted, files)
    gathered.write.partitionBy(*PARTITION_FIELDS).parquet(f"{base}/parts/part={part}")
    covered.select("path", "size", "batch").coalesce(1).write.parquet(f"{base}/covered/part={part}")
    written = spark.read.schema("ingest_ts timestamp").parquet(f"{base}/parts/part={part}")
    bounds = written.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ingest_ts").alias("first_ingest"),
        F.max("ingest_ts").alias("last_ingest"),
    )
    bounds.coalesce(1).write.parquet(f"{base}/files/part={part}")
    found = spark.read.schema(FILE_DDL).parquet(f"{base}/files/part={part}").agg(
        F.sum("rows"), F.min("first_ingest"), F.max("last_ingest")
    )
    batches = spark.read.schema(COVERED_DDL).parquet(f"{base}/covered/part={part}").agg(
        F.min("batch"), F.max("batch")
    )
    written_rows, *span = found.first()
    if (written_rows or 0) != seen.get["rows"]:
        raise RuntimeError(f"part {part} has {written_rows} of {seen.get['rows']} rows")
    return Part(part, level, *batches.first(), written_rows or 0, *span, live)


def _merged(spark: SparkSession, lake: str, kind: EventKind, parts: list[Part], level: int) -> Part:
    base = _base(lake, kind)
    rows = _of_parts(spark, base, "parts", ddl(kind.lake_fields), parts)
    files = _of_parts(spark, base, "files", FILE_DDL, parts)
    covered = _of_parts(spark, base, "covered", COVERED_DDL, parts)
    live = any(part.live for part in parts)
    return _write_part(spark, lake, kind, rows, files, covered, level, live)


def _commit(spark: SparkSession, lake: str, kind: EventKind, shot: Snapshot) -> None:
    rows = [
        (*[getattr(part, name) for name in Part.__dataclass_fields__], len(shot.parts))
        for part in shot.parts
    ]
    path = f"{_base(lake, kind)}/snapshots/version={shot.version}"
    spark.createDataFrame(rows, PART_DDL).coalesce(1).write.mode("overwrite").parquet(path)


def _forget(spark: SparkSession, lake: str, kind: EventKind, current: Snapshot, before: Snapshot) -> None:
    """Remove what neither of the two newest snapshots names.

    A reader has the time from one settling to the next but one to finish; parts of runs that died
    go as well.
    """
    base = _base(lake, kind)
    named = {f"part={part.part}" for shot in (current, before) for part in shot.parts}
    for what in ("parts", "files", "covered"):
        found = folders.names(spark, f"{base}/{what}")
        folders.remove(spark, [f"{base}/{what}/{name}" for name in found if name not in named])
    old = [v for v in _versions(spark, lake, kind) if v not in (current.version, before.version)]
    folders.remove(spark, [f"{base}/snapshots/version={version}" for version in old])


def settle(
    spark: SparkSession,
    lake: str,
    kind: EventKind,
    through: int | None = None,
    *,
    fanout: int = FANOUT,
    drop_live: bool = False,
) -> int | None:
    """Copy the committed files that no snapshot covers; the last batch that is settled.

    ``through`` leaves later batches live. Late events need no rewriting: they come with the
    batch in which they arrived, into the directory of their hour. A run that dies commits no
    snapshot and the next one copies the same files again. One run at a time.

    ``drop_live`` removes the sink's files that the snapshot before the new one covers, for those
    who read the table through ``read_lake`` only.
    """
    before = snapshot(spark, lake, kind)
    waiting = uncovered(spark, lake, kind, before)
    if through is not None:
        waiting = waiting.where(F.col("batch") <= through)
    found = [tuple(row) for row in waiting.select("path", "size", "batch").collect()]
    if not found:
        return before.last_batch
    parts = list(before.parts)
    if drop_live:
        there = [part for part in parts if part.live]
        covered = _of_parts(spark, _base(lake, kind), "covered", COVERED_DDL, there)
        folders.remove(spark, (row["path"] for row in covered.select("path").toLocalIterator()))
        parts = [replace(part, live=False) for part in parts]
    files = spark.createDataFrame(found, COVERED_DDL)
    rows = _open_files(
        spark,
        table_path(lake, kind),
        ddl(kind.lake_fields),
        sorted(path for path, _, _ in found),
    )
    parts.append(_write_part(spark, lake, kind, rows, files, files, 0))
    level = 0
    while len(full := [part for part in parts if part.level == level]) >= fanout:
        whole = _merged(spark, lake, kind, full, level + 1)
        parts = [part for part in parts if part.level != level] + [whole]
        level += 1
    current = Snapshot(before.version + 1, tuple(parts))
    _commit(spark, lake, kind, current)
    _forget(spark, lake, kind, current, before)
    return current.last_batch
