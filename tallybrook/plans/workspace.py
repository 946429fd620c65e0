"""Folders for query results and checkpoints that every executor can reach."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallybrook-")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Only a local session without that setting may use a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{purpose}-{uuid4().hex}"
