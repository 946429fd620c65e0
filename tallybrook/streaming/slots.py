"""Small results of micro-batches, in folders that are used in turn.

A batch writes its results to slots by its number, and then a mark. A batch that is repeated
after a restart writes the same slots again and so counts once; what has no mark is not read.
Every run, that is every checkpoint, has a folder of its own, and readers follow the run that
began last: numbers of an older checkpoint can't be mistaken for newer ones.
"""

from __future__ import annotations

import json
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = 60
MARK_DDL = "batch_id bigint"
RUN_DDL = "began double, run string"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the query that a checkpoint belongs to."""
    written = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()
    return json.loads(written["value"])["id"]


def write(result: DataFrame, path: str, batch_id: int) -> None:
    stamped = result.withColumn("batch_id", F.lit(batch_id).cast("long"))
    stamped.write.mode("overwrite").parquet(path)


def mark(spark: SparkSession, path: str, run: str, batch_id: int) -> None:
    """The batch's results are whole; the first one of a run makes it the current run."""
    done = spark.range(batch_id, batch_id + 1, 1, 1).toDF("batch_id")
    done.write.mode("overwrite").parquet(f"{path}/{run}/marks/slot={batch_id % MARKS}")
    if batch_id == 0:
        began = spark.createDataFrame([(time.time(), run)], RUN_DDL)
        began.coalesce(1).write.mode("append").parquet(f"{path}/runs")


def _read_if_any(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def marks(spark: SparkSession, path: str) -> tuple[str, list[int]]:
    """The current run's folder and its whole batches; no batches before the first one."""
    found = _read_if_any(spark, f"{path}/runs", RUN_DDL)
    last = found.agg(F.max(F.struct("began", "run")).alias("last")).first()["last"]
    if last is None:
        return path, []
    folder = f"{path}/{last['run']}"
    rows = _read_if_any(spark, f"{folder}/marks", MARK_DDL).select("batch_id").collect()
    return folder, sorted(row["batch_id"] for row in rows)


def read(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """One batch's result by its path. A reader that was overtaken fails: no other batch's
    rows, and no missing ones, are taken for this batch's."""
    rows = spark.read.schema(f"{schema}, {MARK_DDL}").parquet(path)
    same = F.assert_true(F.col("batch_id") == batch_id, F.lit(f"batch {batch_id} was replaced"))
    return rows.where(same.isNull()).drop("batch_id")
