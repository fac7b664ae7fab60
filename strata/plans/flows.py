"""The flows a user runs: bronze, dedup and merge, silver, gold, and their run log."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.config import CATEGORICAL, DEFAULTS, RAW_HEADER, TRIMMED, Settings
from strata.functions import geo, json, text
from strata.operators import places, projection
from strata.operators.aggregates import distinct_stats, duplication_stats
from strata.operators.dedup import latest_per_key
from strata.operators.features import engineer, gold_dataset, one_hot_sparse
from strata.operators.filters import iqr_filter, require_key
from strata.operators.ids import assign_ids
from strata.operators.quality import quality_report, require_valid
from strata.operators.summary import VIEWS, summary
from strata.operators.upsert import merge_rows, merge_stats, new_keys
from strata.plans.sizing import materialize, measured
from strata.sources import files, partitioned, snapshots

# Fixed value: folder and bare name at the end of a landed file's path.
FILE_LOCATION = r"([^/]+/[^/]+?)\.csv$"


def run_id(now: datetime | None = None) -> str:
    """One id per run, in the order of time."""
    return (now or datetime.now(timezone.utc)).strftime("%Y-%m-%d_%H-%M-%S")


# --- bronze -----------------------------------------------------------------------

def bronze_rows(raw: DataFrame, batch: str, location: str | None = None,
                settings: Settings = DEFAULTS) -> DataFrame:
    """Raw rows under their table names, with location and lineage. ``location`` names
    a column with the crawl path; ``"file"`` takes it from the folder and name of each
    file, as in ``cali/valle-del-cauca.csv``."""
    rows = projection.rename(raw.withColumn("_source", F.col("_metadata.file_path")))
    if location == "file":
        # Paths come encoded, where a plus sign is itself.
        plain = F.url_decode(F.replace(F.col("_source"), F.lit("+"), F.lit("%2B")))
        path = F.regexp_extract(plain, FILE_LOCATION, 1)
        unlike = F.raise_error(F.concat(F.lit("no folder and name in "), plain)).cast("string")
        rows = rows.withColumn("_path", F.when(path != "", path).otherwise(unlike))
        rows = projection.with_location(rows, "_path", settings.location_order).drop("_path")
    elif location is not None:
        rows = projection.with_location(rows, location, settings.location_order).drop(location)
    return projection.lineage(rows, F.col("_source"), batch).drop("_source")


@dataclass(frozen=True)
class Bronze:
    path: str
    rows: DataFrame
    refused: DataFrame

    @cached_property
    def report(self) -> DataFrame:
        """Quality of what was written, read back when it is asked for."""
        return quality_report(self.rows.select(*schemas.RAW_RENAMED.fieldNames()[:10]))


def bronze(
    spark: SparkSession, csv_path: str, table: str, batch: str | None = None,
    location: str | None = None, settings: Settings = DEFAULTS,
) -> Bronze:
    """Listing files to a snapshot, and a quality report of what was written.
    ``location`` as for ``bronze_rows``.

    Records with too few or too many cells are no rows: they go to ``refused`` (file, reason,
    record, batch_id), a table beside the snapshot. Text is parsed once: rows, refused and the
    report read what was written.
    """
    batch = batch or run_id()
    landed = materialize(bronze_rows(files.read_checked_csv(spark, csv_path), batch, location, settings))
    path = snapshots.write_snapshot(landed.filter(F.col(files.CORRUPT).isNull()).drop(files.CORRUPT), table, batch)
    rows = snapshots.read_snapshot(spark, table, batch)
    refused = files.refused_rows(landed, "source_file", RAW_HEADER[schemas.RAW.names[-1]]).withColumn("batch_id", F.lit(batch))
    snapshots.write_snapshot(refused, f"{table}_refused", batch)
    return Bronze(path, rows, snapshots.read_snapshot(spark, f"{table}_refused", batch))


# --- dedup and merge --------------------------------------------------------------

@dataclass(frozen=True)
class Merge:
    rows: DataFrame
    duplicates: DataFrame

    def stats(self) -> DataFrame:
        return merge_stats(self.rows)

    def totals(self) -> DataFrame:
        return distinct_stats(self.rows, [c for c in ("url", "department", "city") if c in self.rows.columns])


def prepared(batch: DataFrame, key: str = "url", version: str = "fecha") -> DataFrame:
    """Keys and texts trimmed, date text read with its time of day, unusable rows out."""
    rows = batch.withColumns(text.trimmed(c for c in TRIMMED if c in batch.columns))
    if dict(rows.dtypes)[version] == "string":
        rows = rows.withColumn(version, text.parse_timestamp(F.col(version)))
    return require_key(rows, [key, version])


def numbered(batch: DataFrame, target: DataFrame, batch_id: str, settings: Settings = DEFAULTS) -> tuple[DataFrame, bool]:
    """The rows to merge: trimmed, newest per url, dated, with lineage, and with ids where
    the url is new; and whether they are small enough to broadcast."""
    best = latest_per_key(prepared(batch)).withColumn("fecha", F.to_date("fecha")).withColumn(
        "batch_id", F.lit(batch_id)
    )
    if "ingestion_timestamp" in target.columns:
        best = best.withColumn("ingestion_timestamp", F.current_timestamp())
    best, size = measured(projection.select_existing(best, [c for c in target.columns if c != "id_house"]))
    small = size <= settings.broadcast_bytes
    last = target.agg(F.coalesce(F.max("id_house"), F.lit(0))).first()[0]
    ids = assign_ids(new_keys(target, best.select("url"), "url", small), "url", start=last + 1)
    return best.join(F.broadcast(ids) if small else ids, "url", "left"), small


def dedup_merge(
    batch: DataFrame, target: DataFrame, batch_id: str, strategy: str = "latest_wins",
    settings: Settings = DEFAULTS,
) -> Merge:
    """One batch into a keyed frame, as one plan. ``target`` needs ``id_house``, ``url`` and
    ``fecha`` (a date)."""
    rows, small = numbered(batch, target, batch_id, settings)
    # One row per url by construction, and measured.
    kept = rows.select(F.col("url").alias("_key"), F.struct(*rows.columns).alias("_new"))
    merged = merge_rows(target, kept, rows.columns, "url", "fecha", strategy, ["id_house"], small)
    return Merge(merged, duplication_stats(batch, "url", settings.max_duplicate_ratio))


KEYED = "id_house long, fecha date, " + ", ".join(
    f"{c} string" for c in schemas.RAW_RENAMED.fieldNames() if c != "fecha"
) + ", ingestion_timestamp timestamp, batch_id string"


def merge_into_table(spark: SparkSession, batch: DataFrame, table: str, batch_id: str, strategy: str = "latest_wins",
                     settings: Settings = DEFAULTS) -> DataFrame:
    """One batch into the table in partitions (department, city); only the partitions its
    rows are in, or were in, are written. The counts per action come back.

    ``batch_id`` is lineage and says nothing about age: that is what ``fecha`` is for. A batch
    that is sent again leaves the table as it is.
    """
    require_valid(batch, ("url", "fecha"), "batch")
    by = settings.partition_columns
    current = partitioned.read_current(spark, table, by)
    rows, _ = numbered(batch, spark.createDataFrame([], KEYED) if current is None else current, batch_id, settings)
    if current is None:
        rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c)
                             for c, t in spark.createDataFrame([], KEYED).dtypes])
    return partitioned.upsert_partitions(spark, table, rows, "url", by, "fecha", strategy)


# --- silver -----------------------------------------------------------------------

def parsed(df: DataFrame) -> DataFrame:
    """JSON columns to flat text columns, one row per unit; listings without units stay.

    A field is taken from the full info, else the item, else the unit.
    """
    rows = df.withColumns({
        "full_info": json.parse_struct(F.col("full_info"), schemas.FULL_INFO),
        "item": json.parse_struct(F.col("item"), schemas.ITEM),
        "unidades": json.parse_units(F.col("unidades")),
    })
    rows = projection.flatten_struct(rows, "full_info")
    rows = projection.flatten_struct(rows, "item", prefix="item_")
    rows = projection.coalesce_sources(rows, {c: [c, f"item_{c}"] for c in ("estrato", "estado", "parqueaderos")})
    for c in ("financiacion", "cuota_inicial", "pisos_interiores", "aplica_subsidio"):
        rows = rows.withColumnRenamed(f"item_{c}", c)
    rows = rows.drop("item_estrato", "item_estado", "item_parqueaderos")
    rows = projection.explode_outer_units(rows, "unidades")
    rows = projection.flatten_struct(rows, "unidades", prefix="unit_")
    rows = projection.coalesce_sources(rows, {c: [c, f"unit_{c}"] for c in schemas.UNIT_FIELDS})
    return rows.drop(*[f"unit_{c}" for c in schemas.UNIT_FIELDS])


def typed(df: DataFrame, mode: str = "reference") -> DataFrame:
    """Text columns to numbers and flags."""
    built, private = (text.parse_area(F.col(c), mode) for c in ("area_construida", "area_privada"))
    return df.withColumns({
        "precio": text.parse_price(F.col("precio"), mode),
        "financiacion": text.presence_flag(F.col("financiacion")),
        "parqueaderos": text.presence_flag(F.col("parqueaderos")),
        "habitaciones": text.first_int(F.col("habitaciones")),
        "estrato": text.try_int(F.col("estrato")),
        "banos": text.try_int(F.col("banos")),
        "area_construida": built,
        "area_privada": F.coalesce(private, built),
        "pisos_interiores": text.default_if_missing(F.col("pisos_interiores")),
        "lat": geo.point_lat(F.col("lat_lon")),
        "lon": geo.point_lon(F.col("lat_lon")),
    })


def silver_clean(df: DataFrame, counts: DataFrame, mode: str = "reference", settings: Settings = DEFAULTS) -> DataFrame:
    """Keyed rows to clean typed rows with the place counts of their cell; all parsed
    columns stay."""
    return places.enrich_poi(typed(parsed(df), mode), counts, settings.cell_km)


@dataclass(frozen=True)
class Silver:
    path: str
    rows: DataFrame
    settings: Settings = DEFAULTS

    @cached_property
    def report(self) -> DataFrame:
        """Quality of what was written, read back when it is asked for."""
        bounds = {"precio": self.settings.price_bounds, "area_construida": self.settings.area_bounds}
        plain = [n for n, t in self.rows.dtypes if n not in ("processing_timestamp", "batch_id") and not t.startswith(("array", "struct", "map"))]
        return quality_report(self.rows.select(*plain), bounds)


def spread(df: DataFrame, size: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows whose work outweighs their bytes, over all cores: adaptive execution sizes tasks
    by bytes, and would parse a few megabytes of JSON in one. Frames with enough bytes for every
    core are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size >= cores * settings.parse_bytes:
        return df
    return df.repartition(max(1, min(4 * cores, size // settings.least_parse_bytes)))


def balanced(df: DataFrame, size: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows to parse, in tasks of like size. Many bytes may lie in few files, as the tasks that
    wrote them were few, and a file of one row group is read by one task: they are dealt anew."""
    few = spread(df, size, settings)
    if few is not df:
        return few
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(4 * cores, size // (4 * settings.parse_bytes)))


def silver(spark: SparkSession, listings: DataFrame, counts: DataFrame, table: str, batch: str | None = None,
           mode: str = "reference", settings: Settings = DEFAULTS) -> Silver:
    """Keyed listings to a snapshot of clean rows, checked for their columns and for having
    rows, stamped with time and batch; the report is of what was written."""
    batch = batch or run_id()
    landed, size = measured(listings)
    require_valid(landed, ("url", "full_info", "item", "unidades", "lat_lon"), "silver input")
    clean = silver_clean(balanced(landed, size, settings), counts, mode, settings).withColumns(
        {"processing_timestamp": F.current_timestamp(), "batch_id": F.lit(batch)})
    path = snapshots.write_snapshot(clean, table, batch)
    return Silver(path, snapshots.read_snapshot(spark, table, batch), settings)


# --- gold -------------------------------------------------------------------------

@dataclass(frozen=True)
class Gold:
    """The written data set and features, and what is derived from them on request."""

    dataset: DataFrame
    features: DataFrame
    settings: Settings = DEFAULTS

    def view(self, name: str) -> DataFrame:
        return VIEWS[name](self.features)

    def summary(self) -> DataFrame:
        return summary(self.features, written=True)

    def encoded(self) -> tuple[DataFrame, DataFrame]:
        """Features with their categories as slots, and the table of slots."""
        return one_hot_sparse(self.features, CATEGORICAL)

    def report(self) -> DataFrame:
        bounds = {"precio": self.settings.price_bounds, "area_construida": self.settings.area_bounds}
        return quality_report(self.dataset, bounds)


def gold(df: DataFrame, settings: Settings = DEFAULTS) -> Gold:
    """Data set, derived columns, outliers out.

    The data set is written once, since quartiles and filter both read it, and so are
    the features every output reads.
    """
    require_valid(df, ("precio", "area_construida"), "gold input")
    dataset = materialize(gold_dataset(df, settings.price_bounds, settings.area_bounds))
    features = materialize(iqr_filter(engineer(dataset), "precio", settings.iqr_factor, written=True))
    return Gold(dataset, features, settings)


def write_gold(result: Gold, base: str, version: str, by: Sequence[str] = DEFAULTS.partition_columns) -> dict[str, str]:
    """Features, encoding and views as snapshots, summary and report as JSON rows."""
    stamped = result.features.withColumns({"processing_timestamp": F.current_timestamp(), "batch_id": F.lit(version)})
    paths = {"features": snapshots.write_snapshot(stamped, f"{base}/features", version, by=by)}
    for name, rows in zip(("encoded", "slots"), result.encoded()):
        paths[name] = snapshots.write_snapshot(rows, f"{base}/{name}", version)
    for name in VIEWS:
        paths[name] = snapshots.write_snapshot(result.view(name), f"{base}/{name}", version)
    for name, rows in (("summary", result.summary()), ("report", result.report())):
        paths[name] = f"{base}/{name}/{version}"
        files.write_json_rows(rows, paths[name])
    return paths


# --- run log ----------------------------------------------------------------------

def run_sources(spark: SparkSession, jobs: Mapping[str, Callable[[], object]], log_path: str, run: str | None = None) -> str:
    """Run each source on its own; one that fails does not stop the others. Outcomes are
    appended to the log, and the overall status is returned."""
    run = run or run_id()
    rows = []
    for source, job in jobs.items():
        try:
            rows.append((run, source, "success", str(job() or "")))
        except Exception as e:  # noqa: BLE001 - the outcome is the result
            rows.append((run, source, "failed", "".join(traceback.format_exception_only(e))))
    failed = sum(r[2] == "failed" for r in rows)
    status = "success" if not failed else "failed" if failed == len(rows) else "partial_failure"
    rows.append((run, "", status, f"{len(rows) - failed} of {len(rows)} sources"))
    columns = "run_id string, source string, status string, detail string"
    spark.createDataFrame(rows, columns).withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(log_path)
    return status
