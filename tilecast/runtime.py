"""Shared storage for intermediate tables, and checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows a table of keys may have to be broadcast (some 100 bytes each, so about 50 MB).
MAX_BROADCAST_ROWS = 500_000


#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that the session names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL.get(context.applicationId) or tempfile.mkdtemp(prefix="tilecast-")
        _LOCAL[context.applicationId] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    The result survives the loss of executors and reads back only the columns that later
    steps use.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after a count has shown that ``df`` is small enough."""
    return F.broadcast(df) if df.count() <= max_rows else df
