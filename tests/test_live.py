"""Volume alerts with state, the stream of landed CSV, and page numbers in blocks."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import pages
from strata.streaming import alerts, ingest

DAY0 = dt.datetime(2025, 1, 1)


def land(spark, path, events):
    """A file of (hour, source, records), one row per record."""
    rows = [(DAY0 + dt.timedelta(hours=h, minutes=i % 60), s) for h, s, n in events for i in range(n)]
    spark.createDataFrame(rows, "ts timestamp, source string").coalesce(1).write.mode("append").parquet(path)


def drain(spark, src, out, mark, **more):
    stream = ingest.read_batches(spark, src, "ts timestamp, source string", 1)
    ingest.append_stream(alerts.live_volume(stream, "ts", "source", **more), out, mark).awaitTermination()
    return spark.read.schema(alerts.ALERT).parquet(out)


def rounded(df):
    return sorted(map(repr, (tuple(r) for r in df.withColumns({c: F.round(c, 6) for c in ("mean", "deviation")}).select(*alerts.ALERT.names).collect())))


@pytest.fixture
def folders(spark, tmp_path):
    alerts.keep_state(spark)
    yield [str(tmp_path / n) for n in ("src", "out", "mark")]
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


HOURS = [(h, s, 5 + (h * k) % 4) for h in range(10) for s, k in (("a", 1), ("b", 3))]


def test_state_lives_on_between_starts(spark, folders):
    """Three files, three starts; one source is late by less than the delay, and bursts."""
    src, out, mark = folders
    lots = [[e for e in HOURS if e[0] < 4], [e for e in HOURS if 4 <= e[0] < 8] + [(3, "b", 2)], [e for e in HOURS if e[0] >= 8] + [(9, "a", 90), (30, "c", 1)]]
    for lot in lots:
        land(spark, src, lot)
        drain(spark, src, out, mark, delay="2 hours")
    everything = spark.read.parquet(src)
    expected = alerts.volume_by_source(everything, "ts", "source").filter("source <> 'c'")
    got = spark.read.schema(alerts.ALERT).parquet(out)
    assert rounded(got) == rounded(expected)
    assert [r.source for r in got.filter("anomaly").collect()] == ["a"]


def test_rows_later_than_the_delay_do_not_count(spark, folders):
    src, out, mark = folders
    land(spark, src, [(0, "a", 5), (1, "a", 5), (6, "a", 1)])
    drain(spark, src, out, mark)
    land(spark, src, [(0, "a", 50), (9, "a", 1)])
    found = drain(spark, src, out, mark)
    assert [(r.window_start.hour, r.records) for r in found.orderBy("window_start").collect()] == [(0, 5), (1, 5), (6, 1)]


def test_a_silent_source_is_told_once(spark, folders):
    src, out, mark = folders
    hour = 3_600_000
    for lot in ([(h, s, 3) for h in range(3) for s in ("a", "b")] + [(5, "b", 3)], [(h, "b", 3) for h in range(6, 12)], [(h, "b", 3) for h in range(12, 16)]):
        land(spark, src, lot)
        drain(spark, src, out, mark, silence_ms=4 * hour)
    silent = [(r.source, r.window_start, r.records) for r in spark.read.schema(alerts.ALERT).parquet(out).filter("records = 0").collect()]
    assert silent == [("a", DAY0 + dt.timedelta(hours=7), 0)]


def test_sources_without_a_name_are_one(spark, folders):
    src, out, mark = folders
    land(spark, src, [(0, None, 4), (1, None, 6), (9, "z", 1)])
    found = drain(spark, src, out, mark).orderBy("window_start").collect()
    assert [(r.source, r.records, r.previous) for r in found] == [(None, 4, None), (None, 6, 4)]


# --- landed CSV ---

HEADER = ",".join(f'"{n}"' for n in schemas.RAW.names)


def csv(*rows):
    return "\n".join([HEADER, *(",".join(f'"{c}"' for c in r) for r in rows)]) + "\n"


def test_landed_files_become_rows_once(spark, tmp_path):
    landing, table, mark, archive = (str(tmp_path / n) for n in ("landing", "table", "mark", "archive"))
    os.makedirs(f"{landing}/cali")

    def start():
        landed = ingest.read_landed_csv(spark, f"{landing}/*", "b1", location="file", archive=archive, files_per_trigger=1)
        ingest.bronze_stream(landed, table, mark).awaitTermination()

    for name in ("valle", "norte", "sur"):
        with open(f"{landing}/cali/{name}.csv", "w") as f:
            f.write(csv([f"{name}{c}" for c in range(10)], ["a", "few"], ["line\nbreak"] * 10))
        start()
    start()
    rows = spark.read.parquet(f"{table}/rows")
    assert sorted((r.fecha, r.city, r.department) for r in rows.filter("fecha <> 'line\nbreak'").collect()) == [
        ("norte0", "cali", "norte"), ("sur0", "cali", "sur"), ("valle0", "cali", "valle")]
    assert rows.count() == 6 and rows.select("source_file").distinct().count() == 3
    refused = spark.read.parquet(f"{table}/refused").collect()
    assert sorted((os.path.basename(r.file), r.reason) for r in refused) == [(f"{n}.csv", "too few cells") for n in ("norte", "sur", "valle")]
    # A file is moved once a later trigger has found it done.
    assert glob.glob(f"{archive}/**/valle.csv", recursive=True) and not os.path.exists(f"{landing}/cali/valle.csv")


def test_replayed_files_of_a_micro_batch_are_written_anew(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    os.makedirs(f"{landing}/cali")
    with open(f"{landing}/cali/valle.csv", "w") as f:
        f.write(csv(["v"] * 10))
    for mark in ("one", "two"):  # the second checkpoint starts again at micro-batch 0
        ingest.bronze_stream(ingest.read_landed_csv(spark, f"{landing}/*", "b1"), table, str(tmp_path / mark)).awaitTermination()
    assert spark.read.parquet(f"{table}/rows").count() == 1


# --- page numbers ---

def index(n):
    return f'<ul><li class="ant-pagination-item">{n}</li></ul>'


def test_a_long_range_is_spread_over_all_tasks(spark, rows):
    df = rows("page_id int, url string, html string", [(1, "/a", index(5_000_000)), (2, "/b", index(3)), (3, "/c", None)]).coalesce(1)
    found = pages.crawl_frontier(df)
    parts = found.groupBy(F.spark_partition_id()).count().collect()
    cores = spark.sparkContext.defaultParallelism
    assert len(parts) >= cores and max(r["count"] for r in parts) < 2 * 5_000_000 / len(parts)
    figures = found.groupBy("page_id").agg(F.count("page"), F.count_distinct("page"), F.min("page"), F.max("page")).orderBy("page_id").collect()
    assert [tuple(r) for r in figures] == [(1, 5_000_000, 5_000_000, 1, 5_000_000), (2, 3, 3, 1, 3), (3, 1, 1, 1, 1)]
    assert dict(found.dtypes)["page"] == "int"


@pytest.mark.parametrize("block", [1, 2, 7, 100])
def test_blocks_do_not_show(rows, block):
    df = rows("page_id int, url string, html string", [(i, f"/{i}", index(n)) for i, n in enumerate((1, 2, 6, 7, 8, 14, 0))])
    plain = sorted(map(tuple, pages.crawl_frontier(df).collect()))
    assert sorted(map(tuple, pages.crawl_frontier(df, block=block).collect())) == plain and len(plain) == 39
    assert pages.crawl_frontier(df.limit(0), block=block).collect() == []
