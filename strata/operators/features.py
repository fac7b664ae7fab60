"""Derived columns of the analytic data set; division by zero takes a stated default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import CATEGORICAL, DEFAULTS, GOLD_COLUMNS, POI_CATEGORIES
from strata.operators.aggregates import distinct_rows
from strata.operators.filters import drop_nulls, in_range, iqr_filter
from strata.operators.ids import assign_ids
from strata.operators.projection import quoted, select_existing
from strata.plans.sizing import broadcast_if_small, materialize


def _ratio(over: str, under: str) -> Column:
    return F.try_divide(F.col(over).cast("double"), F.col(under).cast("double"))


def price_per_m2(df: DataFrame) -> DataFrame:
    """Rows where it is undefined go."""
    return df.withColumn("precio_por_m2", _ratio("precio", "area_construida")).dropna(subset=["precio_por_m2"])


def area_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("ratio_area", F.coalesce(_ratio("area_privada", "area_construida"), F.lit(1.0)))


def poi_density(df: DataFrame) -> DataFrame:
    have = [c for c in POI_CATEGORIES if c in df.columns]
    if not have:
        return df
    total = reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in have]).cast("long")
    return df.withColumn("poi_total", total).withColumn(
        "poi_density", F.coalesce(_ratio("poi_total", "area_construida"), F.lit(0.0))
    )


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "estrato_area": F.col("estrato") * F.col("area_construida"),
        "habitaciones_banos": F.col("habitaciones") * F.col("banos"),
    })


def lat_lon_product(df: DataFrame) -> DataFrame:
    return df.withColumn("lat_lon_combined", F.col("lat") * F.col("lon"))


def price_per_room(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "precio_por_habitacion", F.coalesce(_ratio("precio", "habitaciones"), F.col("precio"))
    )


def area_per_room(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "area_por_habitacion", F.coalesce(_ratio("area_construida", "habitaciones"), F.col("area_construida"))
    )


def engineer(df: DataFrame) -> DataFrame:
    """All derived columns, in one projection after Catalyst has folded the steps."""
    for step in (price_per_m2, area_ratio, poi_density, interactions):
        df = df.transform(step)
    if {"lat", "lon"} <= set(df.columns):
        df = df.transform(lat_lon_product)
    return df.transform(price_per_room).transform(area_per_room)


def gold_dataset(
    df: DataFrame, price_bounds=DEFAULTS.price_bounds, area_bounds=DEFAULTS.area_bounds
) -> DataFrame:
    """Analytic columns, distinct, complete, within bounds.

    The range and null filters commute with removing equal rows, so they run first
    and shrink what is shuffled.
    """
    chosen = select_existing(df, GOLD_COLUMNS)
    bounds = {"precio": price_bounds, "area_construida": area_bounds}
    return distinct_rows(in_range(drop_nulls(chosen), bounds))


def gold_features(df: DataFrame, target: str = "precio", k: float = DEFAULTS.iqr_factor, **bounds) -> DataFrame:
    """Data set, derived columns, price outliers removed.

    Quartiles and filter both read the data set, so it is written once between.
    """
    return iqr_filter(engineer(materialize(gold_dataset(df, **bounds))), target, k, written=True)


def _codes(df: DataFrame, column: str) -> DataFrame:
    """``_text, _code``: the distinct texts of a column, numbered from 0 in their order."""
    texts = df.select(quoted(column).cast("string").alias("_text")).filter(F.col("_text").isNotNull()).distinct()
    return assign_ids(texts, "_text", column="_code", start=0)


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each text by its place among the sorted distinct texts, from 0.

    Ranks come from range partitions with offsets, whatever the number of texts;
    the code table is broadcast only if its measured size allows. Null stays null.
    """
    for c in columns:
        codes = broadcast_if_small(_codes(df, c))
        df = (
            df.withColumn("_text", quoted(c).cast("string"))
            .join(codes, "_text", "left")
            .withColumn(c, F.col("_code"))
            .drop("_text", "_code")
        )
    return df


def categories(df: DataFrame, column: str, limit: int = DEFAULTS.max_categories) -> list[str]:
    """Sorted distinct texts of a column, refused above ``limit``."""
    rows = df.select(quoted(column).cast("string")).distinct().dropna().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} categories; use one_hot_sparse")
    return sorted(r[0] for r in rows)


def one_hot(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL, known: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """0/1 column ``col_value`` per category but the first sorted one; the source
    columns go. Pass ``known`` categories to skip the job that finds them."""
    have = [c for c in columns if c in df.columns]
    flags = []
    for c in have:
        values = (known or {}).get(c) or categories(df, c)
        flags += [
            F.when(quoted(c).cast("string") == v, 1).otherwise(0).alias(f"{c}_{v}") for v in sorted(values)[1:]
        ]
    return df.select(*[quoted(c) for c in df.columns if c not in have], *flags)


def one_hot_sparse(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> tuple[DataFrame, DataFrame]:
    """The same encoding for any number of categories: instead of a column for each, a list
    ``hot`` of the slots that are 1, and a table ``column, value, slot`` that names the slots.
    The first sorted value of a column has no slot, null has none, the source columns go.

    Slots of a column follow those of the one before it; values are numbered by range
    partitions and never collected.
    """
    have = [c for c in columns if c in df.columns]
    rest = [c for c in df.columns if c not in have]
    slots, held, offset = [], [], 0
    for i, c in enumerate(have):
        named = materialize(_codes(df, c).filter("_code > 0").select(
            F.lit(c).alias("column"), F.col("_text").alias("value"), (F.col("_code") - 1 + F.lit(offset)).alias("slot")))
        side = broadcast_if_small(named.select(F.col("value").alias(f"_v{i}"), F.col("slot").alias(f"_s{i}")))
        df = df.join(side, quoted(c).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        slots.append(named)
        held.append(F.col(f"_s{i}"))
        offset += named.count()
    hot = F.array_compact(F.array(*held)) if held else F.array().cast("array<long>")
    empty = df.sparkSession.createDataFrame([], "column string, value string, slot long")
    return df.select(*[quoted(c) for c in rest], hot.alias("hot")), reduce(DataFrame.unionByName, slots, empty)
