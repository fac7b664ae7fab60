"""Data quality as rows: shapes, contracts, nulls, empties, duplicates, outliers, volume."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.projection import quoted
from strata.plans.sizing import broadcast_if_small, materialize, row_bytes


def validate(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(check, passed): each required column by name in any case, and at least one row.

    Reads no more than one row.
    """
    have = {c.lower() for c in df.columns}
    filled = df.limit(1).agg((F.count(F.lit(1)) > 0).alias("filled"))
    checks = [
        F.struct(F.lit(f"column:{c}").alias("check"), F.lit(c.lower() in have).alias("passed"))
        for c in required
    ]
    checks.append(F.struct(F.lit("not_empty").alias("check"), F.col("filled").alias("passed")))
    return filled.select(F.inline(F.array(*checks)))


def require_valid(df: DataFrame, required: Sequence[str], name: str = "input") -> DataFrame:
    """The frame itself, or an error that names what is wrong."""
    failed = [r.check for r in validate(df, required).filter("not passed").collect()]
    if failed:
        raise ValueError(f"{name} fails: {', '.join(failed)}")
    return df


def profile_shape(df: DataFrame) -> DataFrame:
    """One row: records, columns, bytes."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("total_bytes"),
    )


def profile_schema(df: DataFrame) -> DataFrame:
    """(position, column, type, records)."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("type"))
        for i, (n, t) in enumerate(df.dtypes)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("records"))
    return counted.select(F.inline(F.array(*entries)), "records")


def _text_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string"]


def _rows(wide: DataFrame, cells: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(metric, column, value) from a one-row frame."""
    structs = [
        F.struct(
            F.lit(m).alias("metric"), F.lit(c).alias("column"),
            F.coalesce(v, F.lit(0)).cast("long").alias("value"),
        )
        for m, c, v in cells
    ]
    return wide.select(F.inline(F.array(*structs)))


def _single_pass(df: DataFrame, measures: Sequence[tuple[str, str, Column]]) -> DataFrame:
    names = [f"_m{i}" for i in range(len(measures))]
    wide = df.agg(*[c.alias(n) for n, (_, _, c) in zip(names, measures)])
    return _rows(wide, [(m, c, F.col(n)) for n, (m, c, _) in zip(names, measures)])


def _null_measures(columns: Sequence[str]):
    return [("null_count", c, F.count_if(quoted(c).isNull())) for c in columns]


def _empty_measures(columns: Sequence[str]):
    return [("empty_count", c, F.count_if(quoted(c).isNull() | (quoted(c) == ""))) for c in columns]


def _outlier_measures(bounds: Mapping[str, tuple[float, float]]):
    out = []
    for c, (lo, hi) in bounds.items():
        number = quoted(c).try_cast("double")
        out.append(("outlier_count", c, F.count_if(number.isNotNull() & ~number.between(lo, hi))))
    return out


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _single_pass(df, _null_measures(columns or df.columns)).drop("metric")


def empty_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null or empty, text columns only."""
    return _single_pass(df, _empty_measures(columns or _text_columns(df))).drop("metric")


def outlier_counts(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside [low, high]; text is read as a number where it is one."""
    return _single_pass(df, _outlier_measures(bounds)).drop("metric")


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def row_hashes(df: DataFrame, names: Sequence[str] = ("_h1", "_h2")) -> list[Column]:
    """Two 64-bit hashes of the row; equal rows have equal ones.

    The built-in hash passes over nulls, so which columns are null is hashed too. Columns
    with maps or variants in them, which it cannot read, are left out.
    """
    parts = [quoted(f.name) for f in df.schema.fields if _hashable(f.dataType)]
    nulls = [quoted(c).isNull() for c in df.columns]
    return [F.xxhash64(F.lit(seed), *parts, *nulls).alias(n) for n, seed in zip(names, (0, 0x5BD1E995))]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(total_rows, duplicate_rows): rows beyond the first of each set of equal rows.

    Only the two hashes of a row are shuffled. Rows whose hashes occur again are then
    compared whole, so the figure is exact; equal ones among them are folded within each
    task first.
    """
    mark = "_h"
    while any(c.lower().startswith(mark) for c in df.columns):
        mark = "_" + mark
    one, two = names = (f"{mark}1", f"{mark}2")
    hashes = row_hashes(df, names)
    repeats = F.col("n") > 1
    groups = materialize(
        df.select(*hashes).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
        # All single rows become one, with null hashes.
        .groupBy(F.when(repeats, F.col(one)).alias(one), F.when(repeats, F.col(two)).alias(two)).agg(F.sum("n").alias("n"))
    )
    again = broadcast_if_small(groups.filter(F.col(one).isNotNull()).select(*names))
    whole = df.select("*", *hashes).join(again, list(names), "left_semi")
    different = whole.groupBy(*[quoted(c) for c in df.columns]).agg(F.lit(1).alias("one")).agg(F.count(F.lit(1)).alias("kept"))
    counted = groups.select("n", F.when(F.col(one).isNull(), F.col("n")).otherwise(F.lit(0)).alias("kept"))
    both = counted.unionByName(different.select(F.lit(0).cast("long").alias("n"), "kept"))
    return both.agg(F.sum("n").alias("total_rows"), F.sum("kept").alias("_d")).select(
        "total_rows", (F.col("total_rows") - F.col("_d")).alias("duplicate_rows"))


def quality_report(
    df: DataFrame, bounds: Mapping[str, tuple[float, float]] | None = None, duplicates: bool = True
) -> DataFrame:
    """(metric, column, value) for rows, duplicates, nulls, empties and outliers.

    All but duplicates come from one scan, which shuffles nothing but partial sums;
    ``duplicates`` reads the rows again, see ``duplicate_rows``."""
    report = _single_pass(
        df,
        [("total_rows", "", F.count(F.lit(1)))] + _null_measures(df.columns)
        + _empty_measures(_text_columns(df)) + _outlier_measures(bounds or {}),
    )
    if not duplicates:
        return report
    return report.unionByName(_rows(duplicate_rows(df), [("duplicate_rows", "", F.col("duplicate_rows"))]))


def quality_by_window(df: DataFrame, ts: str, column: str, width: str = "1 hour") -> DataFrame:
    """Records and nulls per time window; works on a stream that carries a watermark."""
    return df.groupBy(F.window(quoted(ts), width).alias("w")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(quoted(column).isNull()).alias("nulls"),
        F.min(quoted(column)).alias("low"),
        F.max(quoted(column)).alias("high"),
    ).select(F.col("w.start").alias("window_start"), "records", "nulls", "low", "high")


def volume_anomaly(df: DataFrame, batch: str, k: float = 3.0) -> DataFrame:
    """Batches whose record count leaves mean ± k·deviation of all earlier batches.

    The unpartitioned window runs over one row per batch, not over records.
    """
    counts = df.groupBy(quoted(batch).alias("batch")).agg(F.count(F.lit(1)).alias("records"))
    order = Window.orderBy("batch")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    mean, dev = F.avg("records").over(earlier), F.stddev("records").over(earlier)
    return counts.select(
        "batch", "records",
        F.lag("records").over(order).alias("previous"),
        mean.alias("mean"), dev.alias("deviation"),
    ).withColumn(
        "anomaly",
        F.coalesce(F.abs(F.col("records") - F.col("mean")) > F.lit(float(k)) * F.col("deviation"), F.lit(False)),
    )
