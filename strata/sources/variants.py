"""JSON columns stored as VARIANT: any shape goes in, and single fields come out as columns.

Files are shredded: fields that a file's rows share are Parquet columns of their own, so a
query that asks for one field reads that column, and its filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.projection import quoted

_SHREDDING = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


@contextmanager
def _shredding(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _SHREDDING}
    for k, v in _SHREDDING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def as_variants(df: DataFrame, columns: Sequence[str], refused: str | None = None) -> DataFrame:
    """JSON texts to VARIANT. Texts that are no JSON become null; with ``refused`` a column of
    that name keeps them, as a map from column to text, null where all were JSON."""
    # Parsed once: the flag below reads the result.
    parsed = df.withColumns({f"_v_{c}": F.try_parse_json(quoted(c)) for c in columns})
    out = parsed
    if refused is not None:
        bad = F.map_filter(
            F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[
                F.when(F.col(f"`_v_{c}`").isNull(), quoted(c)) for c in columns])),
            lambda _, text: text.isNotNull())
        out = out.withColumn(refused, F.when(F.size(bad) > 0, bad))
    kept = [F.col(f"`_v_{c}`").alias(c) if c in columns else quoted(c) for c in df.columns]
    return out.select(*kept, *([refused] if refused is not None else []))


def write_variants(df: DataFrame, columns: Sequence[str], path: str, by: Sequence[str] = (), refused: str | None = None) -> None:
    """Parquet with the named JSON columns as shredded VARIANT."""
    with _shredding(df.sparkSession):
        writer = as_variants(df, columns, refused).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(path)


def fields(column: str, wanted: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Columns ``name`` out of ``name -> (path, type)``; null where path or type do not fit."""
    return [F.try_variant_get(quoted(column), path, kind).alias(name) for name, (path, kind) in wanted.items()]


def field_schemas(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, schema, filled): the schema that all values of a VARIANT column have in
    common, from one scan; tasks send a schema each."""
    wide = df.agg(*[
        c for i, name in enumerate(columns)
        for c in (F.schema_of_variant_agg(quoted(name)).alias(f"_s{i}"), F.count(quoted(name)).alias(f"_n{i}"))])
    cells = [F.struct(F.lit(name).alias("column"), F.col(f"_s{i}").alias("schema"), F.col(f"_n{i}").alias("filled")) for i, name in enumerate(columns)]
    return wide.select(F.inline(F.array(*cells)))


def explode_variant(df: DataFrame, column: str, wanted: Mapping[str, tuple[str, str]], keep: Sequence[str], outer: bool = False) -> DataFrame:
    """(keep..., pos, fields...): one row per element of a VARIANT array; what is no array has
    none. ``outer`` keeps rows without elements. Elements that are JSON *texts* are read as the objects they hold."""
    spark = df.sparkSession
    view = f"_variants_{abs(hash((column, tuple(keep), tuple(wanted))))}"
    function = "variant_explode_outer" if outer else "variant_explode"
    names = ", ".join(f"`{c}`" for c in keep)
    array = F.when(F.schema_of_variant(quoted(column)).startswith("ARRAY"), quoted(column))
    df.select(*[quoted(c) for c in keep], array.alias("_array")).createOrReplaceTempView(view)
    try:
        each = spark.sql(f"select {names}, pos, value as _element from {view}, lateral {function}(_array)")
    finally:
        spark.catalog.dropTempView(view)
    element = F.coalesce(F.try_parse_json(F.try_variant_get("_element", "$", "string")), F.col("_element"))
    return each.withColumn("_element", F.when(F.schema_of_variant("_element") == "STRING", element).otherwise(F.col("_element"))).select(
        *[quoted(c) for c in keep], "pos", *fields("_element", wanted))
