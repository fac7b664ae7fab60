"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.projection import quoted


def newest_first(version: str, ties: Sequence[str]) -> list[Column]:
    """Descending order by version, then by text ties where null equals empty."""
    return [F.desc_nulls_last(version)] + [F.coalesce(quoted(c), F.lit("")).desc() for c in ties]


def latest_per_key(
    df: DataFrame, key: str = "url", version: str = "fecha",
    ties: Sequence[str] = ("titulo", "constructor"),
) -> DataFrame:
    """One row per key: newest version, ties by text, last by a hash of the whole row,
    so that the choice does not depend on how rows are spread.

    Every task first keeps its own best row per key (window group limit), so a key
    with a third of all rows sends one row per task through the shuffle.
    """
    ties = [c for c in ties if c in df.columns]
    order = newest_first(version, ties) + [F.xxhash64(*[quoted(c) for c in df.columns]).asc()]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(quoted(key)).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")
