"""A keyed Parquet table in partition folders, of which an upsert rewrites only those it
touches, by dynamic partition overwrite.

Folders are named by text columns ``p_<column>`` beside the columns they come from, so null,
empty and number-like values come back as they were; which folder a row lies in means nothing
more. Of a folder that lost all its rows a row stays that ``_live`` says is none.

One writer at a time is assumed. A batch that is sent again right after it was applied changes
nothing. What is written lies in the shared folder first, so a job that dies while folders are
exchanged is mended by running it again before the table is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import DEFAULTS
from strata.operators.projection import quoted
from strata.operators.upsert import merge_stats, upsert
from strata.plans.sizing import broadcast_if_small, materialize, measured

NO_VALUE = "-"


def _folders(by: Sequence[str]) -> list[str]:
    return [f"p_{c}" for c in by]


def _placed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """With the folder columns, which are never null or empty."""
    text = {f: quoted(c).cast("string") for f, c in zip(_folders(by), by)}
    return df.withColumns({f: F.when(t.isNull() | (t == ""), NO_VALUE).otherwise(t) for f, t in text.items()})


def _current(spark: SparkSession, table: str) -> DataFrame | None:
    """All rows with their folder columns, or None for a table not yet written."""
    try:
        found = spark.read.parquet(table).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    # Folder names are text, whatever they look like.
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name.startswith("p_") else f for f in found.fields])
    return spark.read.schema(schema).parquet(table).filter("_live").drop("_live")


def read_current(spark: SparkSession, table: str, by: Sequence[str] = DEFAULTS.partition_columns) -> DataFrame | None:
    """All rows of the table."""
    rows = _current(spark, table)
    return None if rows is None else rows.drop(*_folders(by))


def upsert_partitions(
    spark: SparkSession, table: str, batch: DataFrame, key: str = "url",
    by: Sequence[str] = DEFAULTS.partition_columns, order: str = "fecha", strategy: str = "latest_wins",
) -> DataFrame:
    """Apply a batch with one row per key; rows per action come back, where ``unchanged``
    counts neighbours in rewritten partitions.

    Touched are the partitions of the batch's rows and those where their keys are now,
    since a row may move. Finding the latter reads the key column of the table.
    """
    folders = _folders(by)
    current = _current(spark, table)
    batch = _placed(batch, by)
    if current is None:
        rows = materialize(batch.withColumn("_action", F.lit("inserted")))
        out = rows.withColumn("_live", F.lit(True))
    else:
        batch, size = measured(batch)
        keys = batch.select(quoted(key))
        keys = F.broadcast(keys) if size <= DEFAULTS.broadcast_bytes else keys
        here = current.select(key, *folders).join(keys, key, "left_semi").select(*folders)
        # One row per partition: no more than the file index already keeps on the driver.
        touched = broadcast_if_small(batch.select(*folders).union(here).distinct())
        merged = upsert(current.join(touched, folders, "left_semi"), batch, key, order, strategy)
        rows = materialize(_placed(merged.drop(*folders), by))
        left = touched.join(broadcast_if_small(rows.select(*folders).distinct()), folders, "left_anti")
        out = rows.withColumn("_live", F.lit(True)).unionByName(left.withColumn("_live", F.lit(False)), allowMissingColumns=True)
    # Rebalancing splits a hot partition over several tasks and merges small ones.
    out.drop("_action").hint("rebalance", *folders).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(table)
    return merge_stats(rows)
