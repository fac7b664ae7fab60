"""Multi-column clustering: rows near in several columns come to lie in the same files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.geo import morton
from strata.operators.projection import quoted
from strata.operators.quality import row_hashes
from strata.plans.sizing import row_bytes

POOL = 4_096  # rows that marks are taken from
MARK_CHARS = 256


def width_code(c: Column, low: float, high: float, bits: int) -> Column:
    """Number to one of 2^bits equal-width slots."""
    top = (1 << bits) - 1
    slot = F.floor((c - F.lit(float(low))) * F.lit(float(top + 1)) / F.lit(float(high - low)))
    return F.greatest(F.lit(0), F.least(F.lit(top), slot)).cast("long")


def row_sample(df: DataFrame, columns: Sequence[str], pool: int = POOL, seed: int = 11) -> list[Row]:
    """At most ``pool`` rows, drawn by their bytes, without replacement: those with the
    smallest of exponential draws at the rate of a row's bytes. Each task keeps its smallest
    and the smallest of all tasks are the sample, so it is bounded and adds up however the
    rows are dealt. Texts are cut at ``MARK_CHARS``: they only mark places."""
    shown = [
        F.left(quoted(c), F.lit(MARK_CHARS)).alias(c) if isinstance(df.schema[c].dataType, T.StringType) else _number(df, c).alias(c) for c in columns
    ]
    draw = -F.log(F.lit(1.0) - F.rand(seed)) / row_bytes(df)
    return df.select(*shown, draw.alias("_draw")).orderBy("_draw").limit(pool).collect()


def _number(df: DataFrame, column: str) -> Column:
    c = quoted(column)
    if isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def bucket_codes(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Slot of each column's value by rank among the sampled rows, so that slots hold about
    equal bytes; a value of many rows has one slot. Nulls go to slot 0."""
    count = (1 << bits) - 1
    sample = row_sample(df, columns)
    codes = []
    for name in columns:
        found = sorted(r[name] for r in sample if r[name] is not None)
        marks = sorted({found[len(found) * i // (count + 1)] for i in range(1, count + 1)}) if found else []
        c = quoted(name) if isinstance(df.schema[name].dataType, T.StringType) else _number(df, name)
        codes.append(F.coalesce(F.when(c.isNotNull(), _reached(c, marks)), F.lit(0)))
    return codes


def _reached(c: Column, marks: Sequence) -> Column:
    """How many marks are not above a value."""
    return F.size(F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: m <= c)) if marks else F.lit(0)


def cluster(df: DataFrame, columns: Sequence[str], files: int, bits: int = 6) -> DataFrame:
    """Range-partition into ``files`` parts along the Morton curve of the columns, and
    sort each, so that file statistics prune on any of the columns. Rows that are equal in
    them are told apart by the rest of the row and its place in its file, so that a frequent
    value is spread over as many parts as it needs.

    ``df`` is read from files, as ``measured`` gives it: places there do not change when a
    task runs again."""
    code = morton(bucket_codes(df, columns, bits), bits)
    spread = F.xxhash64(*row_hashes(df), F.monotonically_increasing_id())
    return (
        df.withColumns({"_z": code, "_spread": spread}).repartitionByRange(files, "_z", *columns, "_spread")
        .sortWithinPartitions("_z", *columns).drop("_z", "_spread")
    )


def compact(df: DataFrame, path: str, columns: Sequence[str], total_bytes: int, file_bytes: int = 256 * 1024 * 1024) -> None:
    """Rewrite as clustered files of about ``file_bytes``."""
    files = max(1, -(-total_bytes // file_bytes))
    cluster(df, columns, files).write.mode("overwrite").parquet(path)
