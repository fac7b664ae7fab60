"""Versioned tables on Parquet.

A table is a folder of versions ``v=<id>`` and a log of published ids. A version is
written whole, then published by one appended log row; readers take the largest
published id. The log replaces a second full write of a "latest" copy, and a job that
dies half-way leaves only an unpublished folder. One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.filters import newest_partition
from strata.operators.quality import require_valid

LOG = "version string, published_at timestamp"


def versions(spark: SparkSession, table: str) -> DataFrame:
    """(version, published_at) of a table, empty if it has none."""
    try:
        return spark.read.schema(LOG).json(f"{table}/_log/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def latest_version(spark: SparkSession, table: str, not_after: str | None = None) -> str | None:
    """Largest published id, optionally no later than a given one."""
    log = versions(spark, table)
    if not_after is not None:
        # Ids have one fixed width up to the second, so a day bounds all of its runs.
        log = log.filter(F.substring("version", 1, len(not_after)) <= not_after)
    return log.agg(F.max("version")).first()[0]


def write_snapshot(df: DataFrame, table: str, version: str, by: Sequence[str] = ()) -> str:
    """Write and publish a version; its path is returned."""
    path = f"{table}/v={version}"
    # Else every task would write a file into every folder.
    writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    entry = df.sparkSession.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("published_at")
    )
    entry.coalesce(1).write.mode("overwrite").json(f"{table}/_log/{version}")
    return path


def read_snapshot(spark: SparkSession, table: str, version: str | None = None) -> DataFrame:
    """The newest published version, or a given one."""
    version = version or latest_version(spark, table)
    if version is None:
        raise FileNotFoundError(f"no published version of {table}")
    return spark.read.parquet(f"{table}/v={version}")


def load_incremental(
    spark: SparkSession, table: str, path: str | None = None, run_date: str | None = None,
    required: Sequence[str] = ("url", "fecha"),
) -> DataFrame:
    """Explicit path, else the newest version not after the run date, checked for its
    columns and for having rows."""
    if path is not None:
        df = spark.read.parquet(path)
    else:
        version = latest_version(spark, table, run_date)
        if version is None:
            raise FileNotFoundError(f"no version of {table} up to {run_date}")
        df = read_snapshot(spark, table, version)
    return require_valid(df, required, table)


def newest_batch(spark: SparkSession, path: str, column: str = "batch_id") -> DataFrame:
    """Rows of the newest batch of a table partitioned by batch."""
    return newest_partition(spark.read.parquet(path), column)
