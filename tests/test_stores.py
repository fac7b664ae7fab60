"""Sketches beside batches, VARIANT columns, refused records, and clustering by weight."""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import sketches
from strata.plans import flows
from strata.plans.sizing import measured
from strata.sources import files, layout, variants


# --- sketches ---

def test_sketches_merge_without_the_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    days = [spark.range(i * 20_000, i * 20_000 + 50_000).select((F.col("id") % 70_000).alias("url"), F.lit(None).cast("string").alias("none"),
            F.array(F.col("id") % 3).alias("list")) for i in range(3)]
    for i, day in enumerate([*days, days[0]]):
        sketches.write_sketches(day, day.columns, path, f"d{i % 3}")  # the first batch comes twice
    stored = sketches.read_sketches(spark, path)
    assert stored.count() == 9
    got = {r.column: r for r in sketches.merged_distinct(stored).collect()}
    exact = days[0].union(days[1]).union(days[2]).select("url").distinct().count()
    assert got["url"].distinct == pytest.approx(exact, rel=0.03)
    assert (got["url"].rows, got["url"].repeated) == (150_000, 150_000 - got["url"].distinct)
    assert (got["none"].distinct, got["none"].filled, got["none"].repeat_ratio) == (0, 0, 0.0)
    assert got["list"].distinct == 3
    text = sketches.merged_distinct(stored)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "url" not in text.split("ReadSchema")[1]


def test_sketches_by_group_and_of_nothing(rows):
    df = rows("g string, v double", [("a", 1.0), ("a", 2.0), (None, 1.0), ("b", None)])
    got = {r.g: (r.distinct, r.rows) for r in sketches.merged_distinct(sketches.distinct_sketches(df, ["v"], ["g"]), ["g"]).collect()}
    assert got == {"a": (2, 2), None: (1, 1), "b": (0, 1)}
    none = sketches.merged_distinct(sketches.distinct_sketches(df.limit(0), ["v"])).collect()
    assert [(r.rows, r.distinct) for r in none] == [(0, 0)]


# --- variants ---

def test_variants_are_shredded_and_read_by_field(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.range(500).selectExpr("id", "concat('{\"a\": ', id, ', \"b\": \"t', id % 3, '\"}') as item")
    before = spark.conf.get("spark.sql.variant.writeShredding.enabled", None)
    variants.write_variants(df, ["item"], path)
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled", None) == before
    assert "typed_value" in str(pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).schema)
    read = spark.read.parquet(path)
    assert dict(read.dtypes)["item"] == "variant"
    found = read.filter(variants.fields("item", {"a": ("$.a", "int")})[0] < 5).select("id")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(item" in text  # the filter on a field reaches the scan
    assert sorted(r.id for r in found.collect()) == [0, 1, 2, 3, 4]


def test_variants_of_any_shape(rows, tmp_path):
    data = [(1, '{"a": 1}'), (2, '[1, 2]'), (3, '"text"'), (4, "no json"), (5, None), (6, ""), (7, '{"a": "x"}'), (8, "null")]
    path = str(tmp_path / "v")
    df = rows("id int, `it em` string", data)
    variants.write_variants(df, ["it em"], path, refused="refused")
    back = {r.id: r for r in df.sparkSession.read.parquet(path).select(
        "id", F.to_json("it em").alias("json"), "refused", *variants.fields("it em", {"a": ("$.a", "int")})).collect()}
    assert [back[i].json for i in range(1, 9)] == ['{"a":1}', "[1,2]", '"text"', None, None, None, '{"a":"x"}', "null"]
    assert [back[i].refused for i in range(1, 9)] == [None, None, None, {"it em": "no json"}, None, {"it em": ""}, None, None]
    assert [back[i].a for i in (1, 7)] == [1, None]


def test_variant_arrays_explode(rows):
    df = rows("id int, u string", [(1, '[{"p": 1}, "{\\"p\\": 2}", "no object"]'), (2, "[]"), (3, None), (4, '{"p": 9}')]).select("id", F.parse_json("u").alias("u"))
    got = variants.explode_variant(df, "u", {"p": ("$.p", "int")}, ["id"]).collect()
    assert [(r.id, r.pos, r.p) for r in got] == [(1, 0, 1), (1, 1, 2), (1, 2, None)]
    outer = variants.explode_variant(df, "u", {"p": ("$.p", "int")}, ["id"], outer=True)
    assert {r.id for r in outer.collect()} == {1, 2, 3, 4}


# --- refused records ---

HEADER = ",".join(f'"{n}"' for n in schemas.RAW.names)


def test_bronze_tells_what_it_refused(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    good = lambda i: ",".join(f'"{i}-{c}"' for c in range(10))
    (landed / "a.csv").write_text("\n".join([HEADER, good(1), '"short","of cells"', good(2), good(3) + ',"one more"', '"x\ny","two\nlines"']) + "\n")
    (landed / "b.csv").write_text("\n".join([HEADER, good(4).replace("4-2", "a ""quoted"" b\nc")]) + "\n")
    (landed / "c.csv").write_text(HEADER + "\n")
    made = flows.bronze(spark, str(landed), str(tmp_path / "bronze"), "2025-05-01_00-00-00")
    assert sorted(r.fecha for r in made.rows.collect()) == ["1-0", "2-0", "4-0"]
    assert files.CORRUPT not in made.rows.columns
    refused = sorted(((os.path.basename(r.file), r.reason, r.record.split(",")[0]) for r in made.refused.collect()))
    assert refused == [("a.csv", "too few cells", '"short"'), ("a.csv", "too few cells", '"x\ny"'), ("a.csv", "too many cells", '"3-0"')]
    assert {r.batch_id for r in made.refused.collect()} == {"2025-05-01_00-00-00"}
    total = {r.metric: r.value for r in made.report.collect() if r.column == ""}
    assert total["total_rows"] == 3


def test_nothing_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + ",".join('"v"' for _ in range(10)) + "\n")
    made = flows.bronze(spark, str(tmp_path / "a.csv"), str(tmp_path / "bronze"))
    assert made.refused.collect() == [] and made.rows.count() == 1


# --- clustering ---

def sizes(path):
    return [os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")]


@pytest.mark.parametrize("same", [False, True])
def test_a_frequent_text_is_spread_over_files(spark, tmp_path, same):
    """One text in a third of the rows; with ``same``, those rows are equal in all they are
    clustered by."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("t"),
        (F.lit(0) if same else F.col("id") % 1000).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    rows, _ = measured(df)
    path = str(tmp_path / "c")
    layout.cluster(rows, ["t", "n"], 16).write.parquet(path)
    found = sizes(path)
    assert len(found) == 16 and max(found) <= 1.5 * sum(found) / 16
    assert spark.read.parquet(path).exceptAll(rows).count() == 0 and spark.read.parquet(path).count() == 60_000


def test_marks_go_by_bytes(spark):
    """A tenth of the rows has nine tenths of the bytes, and so of the sample."""
    df = spark.range(20_000).select(F.col("id").alias("n"), F.when(F.col("id") % 10 == 0, F.repeat(F.lit("x"), 2000)).otherwise("x").alias("t"))
    sample = layout.row_sample(df, ["n"], pool=500)
    heavy = sum(r.n % 10 == 0 for r in sample)
    assert len(sample) == 500 and 400 < heavy
    assert layout.row_sample(df.limit(0), ["n"]) == []
    codes = layout.bucket_codes(df.limit(0), ["n", "t"], 4)
    assert df.limit(3).select(*codes).collect() == [(0, 0)] * 3
