"""Where intermediate results go, and when a side is small enough to broadcast."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import DEFAULTS


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose tasks run in the driver's own process gets a folder of its own
    where that setting is missing.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = _local_dir()
    return named


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="strata-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is ever written there twice."""
    return f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}/{name}"


def row_bytes(df: DataFrame) -> Column:
    """Rough bytes of one row: text by its length, numbers by 8, nested as JSON text."""
    total = F.lit(8).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(c))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)).cast("long")
    return total


def materialize(df: DataFrame) -> DataFrame:
    """Write once as a table in the shared folder and read that: lineage is cut, a lost
    executor costs a re-read, every reader sees the same rows, and each reads only the
    columns it needs."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """The frame, written once, and its bytes, counted while writing. A task that runs
    twice can only make the count larger."""
    seen = Observation()
    kept = materialize(df.observe(seen, F.sum(row_bytes(df)).alias("bytes")))
    return kept, int(seen.get["bytes"] or 0)


def broadcast_if_small(df: DataFrame, limit: int = DEFAULTS.broadcast_bytes) -> DataFrame:
    """Broadcast hint behind a measured size; otherwise the plain frame, which then
    goes through a shuffled join that adaptive execution may split on skew."""
    kept, size = measured(df)
    return F.broadcast(kept) if size <= limit else kept
