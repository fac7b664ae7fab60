"""Flows over several runs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog.base import Tables
from catalog.flows import SETTINGS
from catalog.places import CELL_KM
from catalog.sources import RAW_ROWS
from strata.operators import places
from strata.plans import flows
from strata.sources import files, partitioned, snapshots

FOLDER = "/root/testdata/sf0.001"


def raw(spark, day, urls, title):
    names = ("item", "unidades", "full_info", "direccion_principal", "direccion_asociadas", "lat_lon")
    data = [(day, u, title, "c", *["" for _ in names], "d", "x") for u in urls]
    columns = ("fecha", "url", "titulo", "constructor", *names, "department", "city")
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))


def test_merges_into_table(spark, tmp_path):
    table = str(tmp_path / "t")
    count = lambda df: {r.action: r["count"] for r in df.collect()}
    first = raw(spark, "2025-05-02", ["a", " b", "b"], "one")
    assert count(flows.merge_into_table(spark, first, table, "2025-05-02_00-00-00")) == {"inserted": 2}
    late = raw(spark, "01/05/2025", ["a"], "late").union(raw(spark, "2025-05-03", ["b", "c"], "two"))
    assert count(flows.merge_into_table(spark, late, table, "2025-05-03_00-00-00")) == {"refused": 1, "updated": 1, "inserted": 1}
    # The same batch sent again adds nothing, and ids stay.
    assert count(flows.merge_into_table(spark, late, table, "2025-05-03_00-00-00")) == {"refused": 1, "updated": 2}
    state = lambda: {r.url: (r.id_house, r.titulo) for r in partitioned.read_current(spark, table).collect()}
    assert state() == {"a": (1, "one"), "b": (2, "two"), "c": (3, "two")}
    # Another batch of the same second, and one of an older run: both count.
    for batch_id, url in (("2025-05-03_00-00-00", "d"), ("2025-05-01_00-00-00", "e")):
        flows.merge_into_table(spark, raw(spark, "2025-05-04", [url], "late"), table, batch_id)
    assert set(state()) == {"a", "b", "c", "d", "e"}


def test_rows_without_a_partition_stay(spark, tmp_path):
    table, by = str(tmp_path / "t"), ["department"]
    rows = [("a", "1", "d"), ("b", "1", None), ("c", "1", ""), ("e", "1", "~null"), ("f", "1", "~"), ("g", "1", "x=y/%")]
    schema = "url string, fecha string, department string"
    partitioned.upsert_partitions(spark, table, spark.createDataFrame(rows, schema), by=by)
    partitioned.upsert_partitions(spark, table, spark.createDataFrame([("b", "2", ""), ("n", "2", None)], schema), by=by)
    got = {tuple(r[c] for c in ("url", "fecha", "department")) for r in partitioned.read_current(spark, table, by).collect()}
    assert got == {r for r in rows if r[0] != "b"} | {("b", "2", ""), ("n", "2", None)}


def test_merge_keeps_files_of_other_partitions(spark, tmp_path):
    table = str(tmp_path / "t")
    flows.merge_into_table(spark, raw(spark, "2025-05-02", ["a"], "one").union(raw(spark, "2025-05-02", ["b"], "one").withColumn("city", F.lit("y"))), table, "1")
    before = sorted((tmp_path / "t").rglob("p_city=y/*.parquet"))
    flows.merge_into_table(spark, raw(spark, "2025-05-03", ["a", "n"], "two"), table, "2")
    assert sorted((tmp_path / "t").rglob("p_city=y/*.parquet")) == before and len(before) == 1
    assert partitioned.read_current(spark, table).count() == 3


@pytest.mark.parametrize("limit", [1 << 26, -1])
def test_large_and_small_batches_merge_alike(spark, limit):
    from dataclasses import replace

    target = spark.createDataFrame([(1, "a", "2025-05-01"), (2, "b", "2025-05-09")], "id_house long, url string, f string")
    target = target.select("id_house", "url", F.to_date("f").alias("fecha"), F.lit("old").alias("titulo"))
    batch = raw(spark, "2025-05-05", ["a", "b", "c", "d"], "new")
    merge = flows.dedup_merge(batch, target, "x", settings=replace(SETTINGS, broadcast_bytes=limit))
    assert {(r.id_house, r.url, r.titulo, r._action) for r in merge.rows.collect()} == {
        (1, "a", "new", "updated"), (2, "b", "old", "refused"), (3, "c", "new", "inserted"), (4, "d", "new", "inserted"),
    }
    assert merge.totals().first().unique_url == 4


def test_bronze_stamps_its_rows(spark, tmp_path):
    landed = str(tmp_path / "csv")
    files.write_csv(Tables(spark, FOLDER).sql(RAW_ROWS), landed)
    done = flows.bronze(spark, landed, str(tmp_path / "bronze"), "2025-05-01_00-00-00")
    row = done.rows.first()
    assert row.batch_id == "2025-05-01_00-00-00" and row.source_file.startswith("file:") and row.ingestion_timestamp


def test_gold_writes_every_output(spark, tmp_path):
    t = Tables(spark, FOLDER)
    enriched = places.enrich_poi(t.view("v_listing"), places.cell_counts(t.view("v_poi"), CELL_KM), CELL_KM)
    paths = flows.write_gold(flows.gold(enriched, SETTINGS), str(tmp_path), "2025-05-01_00-00-00")
    assert set(paths) == {"features", "encoded", "slots", "summary", "report", "price_by_department", "price_by_type", "area_analysis", "poi_analysis"}
    features = snapshots.read_snapshot(spark, str(tmp_path / "features"))
    encoded = snapshots.read_snapshot(spark, str(tmp_path / "encoded"))
    assert features.count() == encoded.count() > 0 and "department" not in encoded.columns
    assert {"processing_timestamp", "batch_id"} <= set(features.columns)
    slots = snapshots.read_snapshot(spark, str(tmp_path / "slots"))
    assert slots.count() == slots.select("slot").distinct().count() == slots.agg(F.max("slot")).first()[0] + 1
    assert spark.read.text(paths["summary"]).count() > 20


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    table, by = str(tmp_path / "t"), ["department", "city"]

    def batch(*rows):
        return spark.createDataFrame(rows, "url string, fecha string, department string, city string")

    def state():
        return {(r.url, r.fecha, r.department, r.city) for r in partitioned.read_current(spark, table, by).collect()}

    count = lambda df: {r.action: r["count"] for r in df.collect()}
    first = batch(("a", "1", "d", "007"), ("b", "1", "d", "x"), ("c", "1", "e", "y"), ("z", "1", "d", "x"))
    assert count(partitioned.upsert_partitions(spark, table, first, by=by)) == {"inserted": 4}
    files_of = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("p_department=e/**/*.parquet")}
    before = files_of()
    # One row moves and leaves its partition empty, one is refused, one is new.
    second = batch(("a", "2", "d", "x"), ("b", "0", "d", "x"), ("n", "2", "f", "w"))
    done = count(partitioned.upsert_partitions(spark, table, second, by=by))
    assert done == {"updated": 1, "refused": 1, "inserted": 1, "unchanged": 1}
    expected = {("a", "2", "d", "x"), ("b", "1", "d", "x"), ("z", "1", "d", "x"), ("c", "1", "e", "y"), ("n", "2", "f", "w")}
    assert state() == expected and files_of() == before and before
    # Sent again, and a row that comes back to the partition it had left empty.
    assert count(partitioned.upsert_partitions(spark, table, second, by=by)) == {"updated": 2, "refused": 1, "unchanged": 1} and state() == expected
    partitioned.upsert_partitions(spark, table, batch(("a", "3", "d", "007")), by=by)
    assert state() == expected - {("a", "2", "d", "x")} | {("a", "3", "d", "007")}


def test_bronze_takes_the_city_from_the_file(spark, tmp_path):
    folder = tmp_path / "landing" / "cali"
    folder.mkdir(parents=True)
    header = "Fecha,URL,Título,Constructor,Item,Unidades,full_info,Direccion_Principal,Direccion_Asociadas,lat/lon"
    (folder / "valle del cauca+.csv").write_text(header + "\n2025-05-01,u,t,c,{},[],0,d,e,x\n", encoding="utf-8")
    done = flows.bronze(spark, str(tmp_path / "landing/*/*.csv"), str(tmp_path / "b"), "2025-05-01_00-00-00", "file")
    row = done.rows.first()
    assert (row.city, row.department, row.url, row.titulo) == ("cali", "valle del cauca+", "u", "t")
    merged = flows.merge_into_table(spark, done.rows, str(tmp_path / "t"), "2025-05-01_00-00-00")
    assert merged.first().asDict() == {"action": "inserted", "count": 1}
    assert partitioned.read_current(spark, str(tmp_path / "t")).first().city == "cali"


def test_gold_encodes_any_number_of_cities(spark, tmp_path):
    t = Tables(spark, FOLDER)
    many = t.view("v_listing").withColumn("city", F.concat(F.lit("c"), (F.col("id_house") % 1_122).cast("string")))
    enriched = places.enrich_poi(many, places.cell_counts(t.view("v_poi"), CELL_KM), CELL_KM)
    wide = SETTINGS.__class__(price_bounds=(0, 1e12), area_bounds=(0, 1e9), cell_km=CELL_KM)
    paths = flows.write_gold(flows.gold(enriched, wide), str(tmp_path), "2025-05-01_00-00-00")
    assert spark.read.parquet(paths["slots"]).filter("column = 'city'").count() > 1_000 and spark.read.text(paths["report"]).count() > 0


def test_stages_refuse_input_without_their_columns(spark, tmp_path):
    few = spark.createDataFrame([("a",)], "url string")
    for run in (lambda: flows.gold(few), lambda: flows.silver(spark, few, few, str(tmp_path / "s")),
                lambda: flows.merge_into_table(spark, few, str(tmp_path / "t"), "1")):
        with pytest.raises(ValueError):
            run()
