"""Distinct counts that add up: a sketch per batch and column, kept beside the batch.

A figure over all batches reads their sketches, a few kilobytes each, and no rows. The exact
forms are ``aggregates.distinct_stats`` and ``aggregates.duplication_stats``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.projection import quoted

LG = 14  # a standard error of 0.8 %
SKETCHES = "column string, sketch binary, filled long, rows long"


def _counted(df: DataFrame, name: str) -> Column:
    """What a sketch can take; null stays null and is not counted."""
    kind, c = df.schema[name].dataType, quoted(name)
    if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return c
    return F.to_json(F.struct(c)) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """(by..., column, sketch, filled, rows): one row per group and column, from one scan.
    ``filled`` are rows with a value. Tasks send one sketch for each of theirs."""
    sums = [
        c for i, name in enumerate(columns)
        for c in (F.hll_sketch_agg(_counted(df, name), F.lit(lg)).alias(f"_s{i}"), F.count(quoted(name)).alias(f"_f{i}"))
    ]
    wide = df.groupBy(*[quoted(b) for b in by]).agg(F.count(F.lit(1)).alias("_rows"), *sums)
    cells = [
        F.struct(F.lit(name).alias("column"), F.col(f"_s{i}").alias("sketch"), F.col(f"_f{i}").alias("filled"), F.col("_rows").alias("rows"))
        for i, name in enumerate(columns)
    ]
    return wide.select(*[quoted(b) for b in by], F.inline(F.array(*cells)))


def write_sketches(df: DataFrame, columns: Sequence[str], path: str, batch: str, lg: int = LG) -> None:
    """Sketches of one batch below ``path``. A batch that comes again replaces its own."""
    distinct_sketches(df, columns, lg=lg).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """(column, sketch, filled, rows, batch) of all batches."""
    return spark.read.schema(f"{SKETCHES}, batch string").parquet(path)


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, rows, filled, distinct, repeated, repeat_ratio) over all given sketches.
    ``distinct`` is an estimate and never above ``filled``; ``repeated`` are filled rows
    beyond the first of each value, and the ratio their share."""
    merged = sketches.groupBy(*[quoted(b) for b in by], "column").agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("_e"))
    distinct = F.least("_e", "filled")
    return merged.select(
        *[quoted(b) for b in by], "column", "rows", "filled", distinct.alias("distinct"),
        (F.col("filled") - distinct).alias("repeated"),
        F.coalesce(F.try_divide(F.col("filled") - distinct, "filled"), F.lit(0.0)).alias("repeat_ratio"))
