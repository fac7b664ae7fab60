"""Counts, pivots, grouped summaries, describe, value counts, correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import DEFAULTS, POI_CATEGORIES
from strata.operators.projection import quoted
from strata.operators.quantiles import group_quantiles
from strata.plans.sizing import materialize


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def pivot_counts(
    df: DataFrame, key: str, category: str, values: Sequence[str] = POI_CATEGORIES
) -> DataFrame:
    """Rows per key and listed category, side by side, absent ones 0.

    The values are fixed, so there is no job to find them and the schema is stable;
    rows with another category or none still make their key appear.
    """
    return df.groupBy(key).agg(*[
        F.count_if(F.coalesce(quoted(category) == v, F.lit(False))).alias(v) for v in values
    ])


def group_summary(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], order_by: Sequence[Column] = (),
    medians: Mapping[str, str] | None = None, written: bool = False,
) -> DataFrame:
    """Grouped aggregates, optionally with exact medians ``{name: column}``, sorted.
    ``written`` as for quantiles.

    Averages and the like combine before the shuffle. Medians run apart, see
    ``quantiles``, and are joined back one row per group.
    """
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    for name, column in (medians or {}).items():
        found = group_quantiles(df, keys, column, [0.5], [name], written=written)
        found = found.select(*[F.col(k).alias(f"_m_{k}") for k in keys], name)
        on = [out[k].eqNullSafe(found[f"_m_{k}"]) for k in keys]
        out = out.join(found, on, "left").drop(*[f"_m_{k}" for k in keys])
    return out.orderBy(*order_by) if order_by else out


def distribution(df: DataFrame, column: str) -> DataFrame:
    c = quoted(column)
    return df.agg(
        F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("avg"), F.stddev(c).alias("stddev")
    )


def _long(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """(column, value) pairs of the named columns."""
    pairs = [F.struct(F.lit(c).alias("column"), quoted(c).cast(dtype).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


# Names of the statistics, in report order.
STATISTICS = ("mean", "median", "std", "min", "max", "q25", "q75")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, stat, value) with sample deviation and exact quartiles."""
    pairs = materialize(_long(df, columns, "double"))
    moments = pairs.groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = group_quantiles(pairs, ["column"], "value", [0.25, 0.5, 0.75], ["q25", "median", "q75"], written=True)
    wide = moments.join(quartiles, "column", "left")
    return wide.unpivot(["column"], list(STATISTICS), "stat", "value")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count), nulls left out, largest first; one pass for all columns."""
    counted = _long(df, columns, "string").filter(F.col("value").isNotNull())
    return count_by(counted, "column", "value").orderBy(
        "column", F.desc("count"), F.asc("value")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def correlate(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, correlation) of numeric columns with the target over rows where both
    are present, highest first; one aggregate for all columns."""
    columns = list(columns or numeric_columns(df))
    t = quoted(target).cast("double")

    def pair(c: str) -> Column:
        # A constant column has no correlation; the aggregate yields NaN or NULL for it.
        return F.nanvl(F.corr(quoted(c).cast("double"), t), F.lit(None).cast("double"))

    wide = df.agg(*[pair(c).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), quoted(c).alias("correlation")) for c in columns]
    return wide.select(F.inline(F.array(*rows))).orderBy(
        F.desc_nulls_last("correlation"), "column"
    )


def distinct_stats(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows and distinct values per column; exact unless asked otherwise."""
    one = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[one(quoted(c)).alias(f"unique_{c}") for c in columns],
    )


def duplication_stats(
    df: DataFrame, key: str, alert_above: float = DEFAULTS.max_duplicate_ratio
) -> DataFrame:
    """Totals of repeated keys; NULL counts as one key. A hot key collapses to one row
    per task before the shuffle."""
    per_key = count_by(df, key)
    totals = per_key.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("unique_records"),
    )
    duplicates = F.col("total_records") - F.col("unique_records")
    ratio = F.coalesce(F.try_divide(duplicates.cast("double"), F.col("total_records").cast("double")), F.lit(0.0))
    return totals.select(
        "total_records", "unique_records",
        duplicates.alias("duplicate_records"),
        ratio.alias("duplicate_ratio"),
        (ratio > alert_above).alias("alert"),
    )


def top_duplicates(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return count_by(df, key).filter("count > 1").orderBy(F.desc("count"), F.asc(key)).limit(k)


def top_k(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Most frequent values, nulls left out, ties by value."""
    present = df.filter(quoted(column).isNotNull())
    return count_by(present, column).orderBy(F.desc("count"), F.asc(column)).limit(k)


def first_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, count) over equal widths; the maximum falls into the last bin.

    The range is two numbers, read first and used as literals.
    """
    c = quoted(column).cast("double")
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    slot = F.least(F.floor((c - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        df.filter(c.isNotNull())
        .groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("low"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
            "count",
        )
    )
