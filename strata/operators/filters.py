"""Row filters, pushed to the scan wherever they touch raw columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import DEFAULTS
from strata.operators.projection import quoted
from strata.operators.quantiles import quantile_row


def require_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all present and, as text, not empty."""
    types = dict(df.dtypes)

    def present(c: str) -> Column:
        ok = quoted(c).isNotNull()
        return ok & (F.trim(quoted(c)) != "") if types[c] == "string" else ok

    return df.filter(reduce(and_, [present(c) for c in columns]))


def in_range(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Both ends inclusive."""
    return df.filter(reduce(and_, [quoted(c).between(lo, hi) for c, (lo, hi) in bounds.items()]))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset is not None else None)


def iqr_bounds(
    df: DataFrame, column: str, k: float = DEFAULTS.iqr_factor, written: bool = False
) -> tuple[float, float] | None:
    """(Q1 - k*IQR, Q3 + k*IQR) with linear quantiles, or None when there is no value."""
    found = quantile_row(df, column, [0.25, 0.75], written)
    if found is None:
        return None
    q1, q3 = found
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def iqr_filter(df: DataFrame, column: str, k: float = DEFAULTS.iqr_factor, written: bool = False) -> DataFrame:
    """Keep rows within the quartile fences, inclusive. ``written`` as for quantiles.

    The fences are two numbers, so they come back as literals: the filter is then
    pushed to the scan and needs no join.
    """
    bounds = iqr_bounds(df, column, k, written)
    if bounds is None:
        return df.filter(F.lit(False))
    return df.filter(quoted(column).between(*bounds))


def poi_tag_filter(osm: DataFrame, tags: str = "tags") -> DataFrame:
    """Elements tagged as hospital, school, mall or park; nodes and ways only."""
    t = quoted(tags)
    # The tag values that make an element a point of interest.
    wanted = (
        t.getField("amenity").rlike("hospital|school")
        | t.getField("shop").rlike("mall")
        | (t.getField("leisure") == "park")
    )
    return osm.filter(F.col("type").isin("node", "way") & wanted)


def newest_partition(df: DataFrame, column: str = "batch_id") -> DataFrame:
    """Rows of the largest partition value. One small job finds the value; the literal
    filter then prunes every other partition."""
    newest = df.select(F.max(quoted(column))).first()[0]
    return df.filter(F.lit(False)) if newest is None else df.filter(quoted(column) == newest)
