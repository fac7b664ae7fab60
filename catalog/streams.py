"""Stream queries: a derived table lands as files, a stream drains them, its result is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, query
from catalog.sources import RAW_BACK, RAW_ROWS
from strata.plans.sizing import scratch_path
from strata.sources import files
from strata.streaming import alerts, ingest


@query("stream_bronze", RAW_BACK)
def _(t: Tables):
    """Two lots of files, each drained by a start of its own; done files are archived."""
    landing, archive, table, mark = (scratch_path(t.spark, n) for n in ("landing", "archive", "bronze", "mark"))
    rows = t.sql(RAW_ROWS)
    for half in (0, 1):
        files.write_csv(rows.filter(F.pmod(F.xxhash64("URL"), F.lit(2)) == half), f"{landing}/lot{half}")
        landed = ingest.read_landed_csv(t.spark, f"{landing}/*", "2025-05-01_00-00-00", archive=archive)
        ingest.bronze_stream(landed, table, mark).awaitTermination()
    return t.spark.read.parquet(f"{table}/rows").select(
        "fecha", "url", "titulo", "constructor", "item", "unidades", "full_info", "direccion_principal", "direccion_asociadas", "lat_lon")


# Windows of a day that have closed when all events are read and an hour has passed.
CLOSED = """(select max(ts) - interval 1 hour from events)"""
DAYS = f""", d as (select event_type as source, date_trunc('day', ts) as window_start, count(*) as records from events
 where date_trunc('day', ts) + interval 1 day <= {CLOSED} group by 1, 2)"""


def _landed_events(t: Tables, *columns: str):
    src = scratch_path(t.spark, "events")
    rows = t.table("events").select(F.col("ts").cast("timestamp").alias("ts"), *columns)
    rows.write.parquet(src)
    return ingest.read_batches(t.spark, src, rows.schema)


def _drained(t: Tables, stream, out: str):
    ingest.append_stream(stream, out, scratch_path(t.spark, "mark")).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


@query("stream_volume_anomaly", f"""
with x as (select 1){DAYS},
m as (select *, lag(records) over o as previous,
  avg(records) over (partition by source order by window_start rows between unbounded preceding and 1 preceding) as mean,
  stddev_samp(records) over (partition by source order by window_start rows between unbounded preceding and 1 preceding) as deviation
 from d window o as (partition by source order by window_start))
select source, cast(window_start as timestamp) as window_start, records, previous, round(mean, 6) as mean, round(deviation, 6) as deviation,
 coalesce(abs(records - mean) > 1.5 * deviation, false) as anomaly from m""")
def _(t: Tables):
    alerts.keep_state(t.spark)
    stream = alerts.live_volume(_landed_events(t, "event_type"), "ts", "event_type", "1 day", "1 hour", k=1.5)
    found = _drained(t, stream, scratch_path(t.spark, "alerts"))
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "deviation")})


@query("stream_quality", f"""
select date_trunc('day', ts) as window_start, count(*) as records, count(*) - count(value) as nulls, min(value) as low, max(value) as high
from events where date_trunc('day', ts) + interval 1 day <= {CLOSED} group by 1""")
def _(t: Tables):
    stream = ingest.live_quality(_landed_events(t, "value"), "ts", "value", "1 hour", "1 day")
    return _drained(t, stream, scratch_path(t.spark, "quality"))
