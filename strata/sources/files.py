"""Raw files in, files out. Every reader has its schema up front."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.operators.projection import quoted


def read_listings_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.RAW) -> DataFrame:
    """Listing files with header, quoted cells over several lines and doubled quotes.

    A file with multi-line cells is one task: land many files, and keep the result as
    a snapshot rather than reading the text twice.
    """
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", True).option("escape", '"')
        .csv(path)
    )


#: Column with the text of a raw record that does not fit the header.
CORRUPT = "_corrupt_record"


CHECKED = {"header": True, "multiLine": True, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def checked_schema(schema: T.StructType = schemas.RAW) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_checked_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.RAW, header: bool = True
) -> DataFrame:
    """``read_listings_csv`` with ``_corrupt_record``: the text of records that have too few
    or too many cells, else null. Select all columns, or write the frame first: the reader
    judges records by the cells that a query asks for."""
    return spark.read.schema(checked_schema(schema)).options(**CHECKED | {"header": header}).csv(path)


def refused_rows(checked: DataFrame, file: str, last: str) -> DataFrame:
    """(file, reason, record) of the records that did not fit; ``file`` names the column with
    the path of a row's file, ``last`` the last column of the header.

    The reader fills cells from the left: with too few the last column is empty, with too
    many it has a cell, as long as that is not an empty one.
    """
    reason = F.when(quoted(last).isNull(), "too few cells").otherwise("too many cells")
    return checked.filter(F.col(CORRUPT).isNotNull()).select(quoted(file).alias("file"), reason.alias("reason"), F.col(CORRUPT).alias("record"))


def read_quoted_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.RAW, header: bool = True
) -> DataFrame:
    """As above for files with blanks after the delimiter."""
    return (
        spark.read.schema(schema)
        .option("header", header).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", True)
        .csv(path)
    )


def read_osm_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Map documents, each one object with an ``elements`` array, to element rows."""
    documents = spark.read.schema(schemas.OSM).option("multiLine", True).json(path)
    return documents.select(F.inline("elements"))


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Header, doubled quotes, one folder per value of ``by``. Rows of a folder are brought
    together, and a hot one is split over several tasks."""
    writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("department", "city")) -> None:
    """Parquet in one folder per key.

    Rows of a key are brought together, so folders get few files; adaptive rebalancing
    splits a hot key over several tasks and merges small ones.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_json_rows(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.select(F.to_json(F.struct(*[quoted(c) for c in df.columns])).alias("value")).write.mode("overwrite").text(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                connections: int = 16, batch: int = 10_000) -> None:
    """Append to a relational table; the writer opens at most ``connections`` at once.

    A task is one transaction, but a task repeated after its commit adds its rows
    again; keep ``batch_id`` in the table to find such rows.
    """
    (
        df.write.option("numPartitions", connections).option("batchsize", batch).option("isolationLevel", "READ_COMMITTED")
        .jdbc(url, table, mode="append", properties=dict(properties or {}))
    )


def tier_inventory(spark: SparkSession, tiers: Mapping[str, str], suffix: str = "*") -> DataFrame:
    """(tier, files, bytes, newest): what each tier holds. File contents are not read."""
    frames = [
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", suffix)
        .load(path).select(F.lit(tier).alias("tier"), "length", "modificationTime")
        for tier, path in tiers.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("tier").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest")
    )
