"""Grouped views and the long-format summary of the analytic data set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregates import (
    correlate, describe_numeric, group_summary, numeric_columns, top_k, value_counts,
)
from strata.operators.quality import profile_shape
from strata.plans.sizing import materialize


def price_by_department(df: DataFrame, written: bool = False) -> DataFrame:
    """Count, mean, median and range of prices. ``written`` as for quantiles."""
    narrow = df.select("department", "precio")
    return group_summary(
        narrow if written else materialize(narrow), ["department"],
        {
            "total_properties": F.count(F.lit(1)),
            "avg_price": F.avg("precio"),
            "min_price": F.min("precio"),
            "max_price": F.max("precio"),
        },
        order_by=[F.desc("avg_price"), F.asc("department")],
        medians={"median_price": "precio"}, written=True,
    ).select("department", "total_properties", "avg_price", "median_price", "min_price", "max_price")


def price_by_type(df: DataFrame) -> DataFrame:
    return group_summary(
        df, ["tipo_de_inmueble"],
        {
            "total_properties": F.count(F.lit(1)),
            "avg_price": F.avg("precio"),
            "avg_price_per_sqm": F.avg("precio_por_m2"),
        },
        order_by=[F.desc("avg_price"), F.asc("tipo_de_inmueble")],
    )


def area_analysis(df: DataFrame) -> DataFrame:
    return group_summary(
        df, ["department"],
        {
            "avg_area": F.avg("area_construida"),
            "avg_private_area": F.avg("area_privada"),
            "avg_area_ratio": F.avg("ratio_area"),
        },
        order_by=[F.desc("avg_area"), F.asc("department")],
    )


def poi_analysis(df: DataFrame) -> DataFrame:
    return group_summary(
        df, ["department"],
        {
            "avg_poi_count": F.avg("poi_total"),
            "avg_poi_density": F.avg("poi_density"),
            "avg_hospitals": F.avg("hospital"),
            "avg_malls": F.avg("mall"),
            "avg_parks": F.avg("park"),
            "avg_schools": F.avg("school"),
        },
        order_by=[F.desc("avg_poi_density"), F.asc("department")],
    )


# Each takes the feature table as written.
VIEWS = {
    "price_by_department": lambda df: price_by_department(df, written=True),
    "price_by_type": price_by_type,
    "area_analysis": area_analysis,
    "poi_analysis": poi_analysis,
}

# Columns each section of the summary covers, where present.
DESCRIBED = ("precio", "area_construida")
COUNTED = ("department", "estrato", "tipo_de_inmueble", "estado", "financiacion")


def summary(df: DataFrame, target: str = "precio", cities: int = 10, written: bool = False) -> DataFrame:
    """(section, column, item, value): shape, statistics, counts, top cities and
    correlations as rows, built without bringing the data set to the driver. Each part
    reads the data set, which is written once unless it is a ``written`` table."""
    df = df if written else materialize(df)
    have = set(df.columns)
    shape = profile_shape(df).unpivot(
        [], ["total_records", "total_columns", "total_bytes"], "item", "value"
    ).select(F.lit("dataset_info").alias("section"), F.lit("").alias("column"), "item", F.col("value").cast("double").alias("value"))
    parts = [shape]
    described = [c for c in DESCRIBED if c in have]
    if described:
        parts.append(describe_numeric(df, described).select(
            F.lit("analytics").alias("section"), "column", F.col("stat").alias("item"), "value"
        ))
    counted = [c for c in COUNTED if c in have]
    if counted:
        parts.append(value_counts(df, counted).select(
            F.lit("counts").alias("section"), "column", F.col("value").alias("item"),
            F.col("count").cast("double").alias("value"),
        ))
    if "city" in have:
        parts.append(top_k(df, "city", cities).select(
            F.lit("counts").alias("section"), F.lit("city").alias("column"), F.col("city").alias("item"),
            F.col("count").cast("double").alias("value"),
        ))
    numeric = numeric_columns(df)
    if target in numeric and len(numeric) > 1:
        parts.append(correlate(df, target, numeric).select(
            F.lit("correlation").alias("section"), F.lit(target).alias("column"),
            F.col("column").alias("item"), F.col("correlation").alias("value"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
