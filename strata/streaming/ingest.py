"""Streams of listing batches. Each start takes a checkpoint folder of its own, and
``availableNow`` drains what is there and stops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata import schemas
from strata.config import DEFAULTS, RAW_HEADER
from strata.operators.dedup import latest_per_key
from strata.operators.quality import quality_by_window
from strata.plans import flows
from strata.plans.sizing import materialize
from strata.sources import files, partitioned


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder, as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_landed_csv(
    spark: SparkSession, folder: str, batch: str, location: str | None = None,
    archive: str | None = None, files_per_trigger: int | None = None,
) -> DataFrame:
    """New listing files of a landing folder as bronze rows with location and lineage (see
    ``flows.bronze_rows``), and ``_corrupt_record``. Files that a later trigger finds done move
    to ``archive``, a folder outside the landing one."""
    reader = spark.readStream.schema(files.checked_schema()).options(**files.CHECKED)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return flows.bronze_rows(reader.csv(folder), batch, location)


def bronze_stream(landed: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Rows to ``table/rows`` and refused records to ``table/refused``, a folder for each
    micro-batch: one that is replayed writes its own anew, so each record is there once."""

    def apply(batch: DataFrame, number: int) -> None:
        # Judged and written as a whole; both tables come from what was written.
        seen = materialize(batch)
        fits = F.col(files.CORRUPT).isNull()
        seen.filter(fits).drop(files.CORRUPT).write.mode("overwrite").parquet(f"{table}/rows/micro_batch={number}")
        refused = files.refused_rows(seen, "source_file", RAW_HEADER[schemas.RAW.names[-1]])
        refused.write.mode("overwrite").parquet(f"{table}/refused/micro_batch={number}")

    return landed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ()) -> StreamingQuery:
    """Exactly-once append to a Parquet folder."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.partitionBy(*by) if by else writer).trigger(availableNow=True).start()


def first_per_key(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """Repeats of a key within the delay are dropped; state older than it goes."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def upsert_stream(
    stream: DataFrame, table: str, checkpoint: str, by: Sequence[str] = DEFAULTS.partition_columns,
    key: str = "url", version: str = "fecha", strategy: str = "latest_wins",
) -> StreamingQuery:
    """Newest row per key of every micro-batch into a table in partitions; a micro-batch
    rewrites only those it touches. Keys are trimmed and unusable rows left out, as in a
    batch.

    A micro-batch that is replayed finds its rows in the table and changes nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        rows = latest_per_key(flows.prepared(batch, key, version), key, version)
        partitioned.upsert_partitions(batch.sparkSession, table, rows, key, by, version, strategy)

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def live_quality(stream: DataFrame, ts: str, column: str, delay: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Quality figures per closed window; late rows count until the delay has passed."""
    return quality_by_window(stream.withWatermark(ts, delay), ts, column, width)
