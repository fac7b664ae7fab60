"""Keyed upsert of a batch into a table, as one plan over immutable inputs.

Parquet tables have no MERGE, so the result is a new version of the table; see
``sources.snapshots`` for how it replaces the old one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import DEFAULTS
from strata.operators.projection import quoted
from strata.plans.sizing import measured

STRATEGIES = ("latest_wins", "append_only", "overwrite")


def _unique(updates: DataFrame, key: str) -> DataFrame:
    """The updates as (key, row), failing if a key comes twice.

    Copies fold together before the shuffle, and the grouping gives the partitioning
    the following join needs.
    """
    once = updates.groupBy(quoted(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.first(F.struct(*[quoted(c) for c in updates.columns])).alias("_new"),
    )
    message = F.concat(F.lit("update holds this key more than once: "), F.col("_key").cast("string"))
    single = F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return once.filter(single).select("_key", "_new")


def _wins(strategy: str, version: str) -> Column:
    """Whether the update replaces a matched row."""
    if strategy == "overwrite":
        return F.lit(True)
    if strategy == "append_only":
        return F.lit(False)
    new, old = F.col("_new").getField(version), F.col("_old").getField(version)
    return old.isNull() | F.coalesce(new >= old, F.lit(False))


def new_keys(target: DataFrame, batch: DataFrame, key: str, small: bool) -> DataFrame:
    """Rows of the batch whose key the table lacks. Only the key column of the table
    is read; with a small batch it is not shuffled either."""
    known = target.select(quoted(key).alias("_known"))
    if small:
        wanted = F.broadcast(batch.select(quoted(key).alias("_wanted")))
        known = known.join(wanted, F.col("_known") == F.col("_wanted"), "left_semi")
    return batch.join(known, quoted(key) == F.col("_known"), "left_anti")


def upsert(
    target: DataFrame, updates: DataFrame, key: str = "url", version: str = "fecha",
    strategy: str = "latest_wins", keep: Sequence[str] = ("id_house",),
    broadcast_bytes: int = DEFAULTS.broadcast_bytes,
) -> DataFrame:
    """All rows of the table after the batch, plus ``_action``: ``inserted``,
    ``updated``, ``refused`` (matched, but the table's row stays) or ``unchanged``.

    ``latest_wins`` replaces a row by one that is not older, ``append_only`` only adds
    keys, ``overwrite`` always replaces. ``keep`` names columns an update never changes
    (the surrogate id); columns the batch lacks are kept too, and null on insert.

    A batch of checked small size is broadcast and the table is never shuffled; a
    larger one is joined by key.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    columns = target.columns
    unknown = [c for c in updates.columns if c not in columns]
    if unknown:
        raise ValueError(f"updates have columns the table lacks: {unknown}")
    kept, size = measured(_unique(updates, key))
    return merge_rows(target, kept, updates.columns, key, version, strategy, keep, size <= broadcast_bytes)


def merge_rows(
    target: DataFrame, kept: DataFrame, given: Sequence[str], key: str, version: str,
    strategy: str, keep: Sequence[str], small: bool,
) -> DataFrame:
    """The upsert of rows known to have one row per key, as (_key, _new) with ``given``
    fields; ``small`` says that their size has been checked."""
    columns = target.columns
    old = target.select(quoted(key).alias("_key"), F.struct(*[quoted(c) for c in columns]).alias("_old"))

    if small:
        both = old.join(F.broadcast(kept), "_key", "left")
        fresh = new_keys(old, kept, "_key", small=True).select(
            "_key", F.lit(None).cast(old.schema["_old"].dataType).alias("_old"), "_new"
        )
        both = both.select("_key", "_old", "_new").unionByName(fresh)
    else:
        both = old.join(kept, "_key", "full_outer")

    action = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "unchanged")
        .when(_wins(strategy, version), "updated")
        .otherwise("refused")
    )
    both = both.withColumn("_action", action)
    take_new = F.col("_action").isin("inserted", "updated")

    def merged(c: str) -> Column:
        old_value, new_value = F.col("_old").getField(c), F.col("_new").getField(c)
        if c not in given:
            return old_value
        if c in keep:
            return F.when(F.col("_old").isNull(), new_value).otherwise(old_value)
        return F.when(take_new, new_value).otherwise(old_value)

    return both.select(*[merged(c).alias(c) for c in columns], "_action")


def merge_stats(actions: DataFrame) -> DataFrame:
    """Rows per action of an upsert."""
    return actions.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("count"))
