"""Scratch folders that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the session's ``spark.checkpoint.dir``.

    A session without that setting gets a local folder, if its master is local: executors on other
    machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="rowsmith-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
