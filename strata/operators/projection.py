"""Columns: renaming, choosing, flattening, filling from several sources."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import DEFAULTS, RAW_HEADER


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, mapping: Mapping[str, str] = RAW_HEADER) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def plain_name(name: str, ascii_only: bool = False) -> str:
    clean = name.strip().replace("'", "").replace(" ", "_")
    if ascii_only:
        letters = unicodedata.normalize("NFKD", clean)
        clean = re.sub(r"[^0-9A-Za-z_]+", "_", "".join(c for c in letters if not unicodedata.combining(c)))
    return clean


def standardize_names(df: DataFrame, ascii_only: bool = False) -> DataFrame:
    names = [plain_name(n, ascii_only) for n in df.columns]
    lowered = [n.lower() for n in names]
    twice = sorted({n for n in lowered if lowered.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after standardizing: {twice}")
    return df.toDF(*names)


def with_location(df: DataFrame, path: str, order: str = DEFAULTS.location_order) -> DataFrame:
    """Two columns from a ``first/second`` crawl path, named by ``order``."""
    first, second = order.split("/")
    return df.withColumns({
        first: F.split_part(quoted(path), F.lit("/"), F.lit(1)),
        second: F.split_part(quoted(path), F.lit("/"), F.lit(2)),
    })


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns the frame has, matched without regard to case, in wanted order
    and spelling; absent ones are left out."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[quoted(have[w.lower()]).alias(w) for w in wanted if w.lower() in have])


def flatten_struct(
    df: DataFrame, column: str, prefix: str = "", names: Mapping[str, str] | None = None
) -> DataFrame:
    """Replace a struct column by its fields in a single projection."""
    fields = df.schema[column].dataType.fieldNames()
    names = names or {}
    rest = [quoted(c) for c in df.columns if c != column]
    inner = [
        quoted(column).getField(f).alias(names.get(f, prefix + plain_name(f, ascii_only=True).lower()))
        for f in fields
    ]
    return df.select(*rest, *inner)


def coalesce_sources(df: DataFrame, sources: Mapping[str, Sequence[str]]) -> DataFrame:
    """``{target: [best, next, ...]}``: first source that is not null."""
    return df.withColumns({
        target: F.coalesce(*[quoted(c) for c in columns]) for target, columns in sources.items()
    })


def explode_outer_units(df: DataFrame, column: str) -> DataFrame:
    """One row per array element; a row without elements stays, with null fields."""
    return df.withColumn(column, F.explode_outer(quoted(column)))


def explode_elements(df: DataFrame, column: str) -> DataFrame:
    """One row per array element, its fields as columns."""
    return df.select(F.inline(quoted(column)))


def lineage(
    df: DataFrame, source: str | Column, batch: str, processing_column: str = "ingestion_timestamp"
) -> DataFrame:
    """Clock, source and the single batch id of a run."""
    return df.withColumns({
        processing_column: F.current_timestamp(),
        "source_file": F.lit(source) if isinstance(source, str) else source,
        "batch_id": F.lit(batch),
    })


def union_evolved(*frames: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks become null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def append(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name of frames with one schema."""
    first, *rest = list(frames)
    for f in rest:
        first = first.unionByName(f)
    return first
