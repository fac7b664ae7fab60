"""Streams drained with ``availableNow``, compared with the batch result."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from catalog.base import Tables
from strata.operators.dedup import latest_per_key
from strata.operators.quality import quality_by_window
from strata.sources import partitioned
from strata.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


def landed(spark, path):
    """The batches of all users' days as several files."""
    rows = Tables(spark, FOLDER).view("v_daily").select("url", "fecha", "titulo", "event_id", "precio")
    rows.repartition(3, "event_id").write.parquet(path)
    return rows


def rowset(df):
    return Counter(map(tuple, df.collect()))


def test_ingest_appends_each_file_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    rows = landed(spark, src)
    for _ in range(2):
        stream = ingest.read_batches(spark, src, rows.schema, 1)
        ingest.append_stream(stream, out, mark).awaitTermination()
    assert rowset(spark.read.parquet(out)) == rowset(rows)


def run_upsert(spark, src, schema, table, mark, **more):
    ingest.upsert_stream(ingest.read_batches(spark, src, schema, 1), table, mark, ["titulo"], **more).awaitTermination()


def test_upsert_stream_ends_at_the_batch_result(spark, tmp_path):
    src, table, mark = (str(tmp_path / n) for n in ("src", "table", "mark"))
    rows = landed(spark, src)
    for _ in range(2):  # the same checkpoint again changes nothing
        run_upsert(spark, src, rows.schema, table, mark)
    got = partitioned.read_current(spark, table, ["titulo"]).select(*rows.columns)
    assert rowset(got) == rowset(latest_per_key(rows))


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    """A stream that lost its checkpoint sends all it had sent."""
    src, table = (str(tmp_path / n) for n in ("src", "table"))
    rows = landed(spark, src)
    for mark in ("mark1", "mark2"):
        run_upsert(spark, src, rows.schema, table, str(tmp_path / mark))
    got = partitioned.read_current(spark, table, ["titulo"]).select(*rows.columns)
    assert rowset(got) == rowset(latest_per_key(rows))


def test_second_stream_with_new_data_arrives(spark, tmp_path):
    table, schema = str(tmp_path / "table"), "url string, fecha timestamp_ntz, titulo string"
    for n, data in (("1", "('a', '2025-01-01', 'x'), (' q ', '2025-01-01', null)"), ("2", "('zz', '2025-01-01', ''), (null, '2025-01-01', 'x'), (' a', '2025-01-02', 'y')")):
        src = str(tmp_path / f"src{n}")
        spark.sql(f"select c1 as url, cast(c2 as timestamp_ntz) as fecha, c3 as titulo from values {data} as t(c1, c2, c3)").write.parquet(src)
        run_upsert(spark, src, schema, table, str(tmp_path / f"mark{n}"))
    got = {(r.url, r.titulo) for r in partitioned.read_current(spark, table, ["titulo"]).collect()}
    assert got == {("a", "y"), ("q", None), ("zz", "")}


def test_live_quality_matches_batch(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    rows = landed(spark, src).withColumn("fecha", F.col("fecha").cast("timestamp"))
    stream = ingest.read_batches(spark, src, landed(spark, src + "2").schema)
    figures = ingest.live_quality(stream.withColumn("fecha", F.col("fecha").cast("timestamp")), "fecha", "precio")
    query = (
        figures.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed, full = rowset(spark.read.parquet(out)), rowset(quality_by_window(rows, "fecha", "precio"))
    # The last windows stay open until the watermark passes them.
    assert closed and not closed - full and sum(full.values()) - sum(closed.values()) <= 2


def test_first_per_key_drops_repeats(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    rows = landed(spark, src)
    twice = ingest.read_batches(spark, src, rows.schema).withColumn("fecha", F.col("fecha").cast("timestamp"))
    twice = ingest.first_per_key(twice, "url", "fecha", "60 days")
    twice.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == rows.select("url").distinct().count()
