"""Laws that hold for any input, checked on generated rows and against plain Python."""

from __future__ import annotations

import math
import statistics
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import geo
from strata.operators import dedup, features, ids, places, quality, upsert
from strata.operators.quantiles import group_quantiles
from strata.sources import files, layout, snapshots

few = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
keyed = st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(1, 5), st.sampled_from(["x", "y", None])), max_size=30)
SCHEMA = "url string, fecha int, titulo string"


def rowset(df):
    return Counter(map(tuple, df.collect()))


@few
@given(keyed)
def test_dedup_is_idempotent_and_keeps_every_key(spark, data):
    once = dedup.latest_per_key(spark.createDataFrame(data, SCHEMA))
    assert rowset(dedup.latest_per_key(once)) == rowset(once)
    assert {r.url for r in once.collect()} == {d[0] for d in data}
    newest = {k: max(d[1] for d in data if d[0] == k) for k in {d[0] for d in data}}
    assert {r.url: r.fecha for r in once.collect()} == newest


@few
@given(keyed, keyed, keyed)
def test_latest_wins_does_not_depend_on_batch_order(spark, table, first, second):
    def best(rows):
        return dedup.latest_per_key(spark.createDataFrame(rows, SCHEMA))

    # Distinct versions per batch, since an equal version lets the later batch win.
    table, first, second = ([(u, v * 3 + i, t) for u, v, t in rows] for i, rows in enumerate((table, first, second)))

    def apply(*batches):
        out = best(table)
        for b in batches:
            out = upsert.upsert(out, best(b)).drop("_action")
        return rowset(out)

    assert apply(first, second) == apply(second, first)
    assert apply(first, first) == apply(first)


@few
@given(keyed, keyed)
def test_both_upsert_plans_agree(spark, table, batch):
    old, new = (dedup.latest_per_key(spark.createDataFrame(r, SCHEMA)) for r in (table, batch))
    for strategy in upsert.STRATEGIES:
        assert rowset(upsert.upsert(old, new, strategy=strategy)) == rowset(upsert.upsert(old, new, strategy=strategy, broadcast_bytes=-1))


@few
@given(st.lists(st.tuples(st.sampled_from(["g", "h", None]), st.one_of(st.none(), st.floats(-1e6, 1e6), st.integers(0, 3).map(float))), max_size=60))
def test_quantiles_match_the_definition(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    names = [f"p{i}" for i in range(5)]
    got = {r.k: tuple(r)[1:] for r in group_quantiles(df, ["k"], "v", probabilities, names).collect()}
    groups = {k: [v for g, v in data if g == k and v is not None] for k in {g for g, _ in data}}
    assert set(got) == {k for k, v in groups.items() if v}
    for k, found in got.items():
        assert np.allclose(found, np.quantile(groups[k], probabilities), rtol=1e-12, atol=1e-9)


def test_quantiles_stay_exact_with_a_coarse_sketch_and_a_hot_group(spark):
    """Two thirds of the rows in one group, half of those one value, and a sketch of ten."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("k"),
        F.when(F.col("id") % 2 == 0, 7.0).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("v"),
    )
    exact = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", [0.1, 0.5, 0.77]).alias("q")).collect()}
    got = group_quantiles(df, ["k"], "v", [0.1, 0.5, 0.77], ["a", "b", "c"], accuracy=10)
    for r in got.collect():
        assert np.allclose([r.a, r.b, r.c], exact[r.k])


@few
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["", "x"])), st.integers(0, 2)), max_size=12),
       st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["", "x"])), st.integers(0, 2)), max_size=12))
def test_quality_adds_over_a_union(spark, left, right):
    schema = "s string, n int"

    def report(rows):
        df = spark.createDataFrame(rows, schema)
        return {(r.metric, r.column): r.value for r in quality.quality_report(df, {"n": (1, 1)}).collect() if r.metric != "duplicate_rows"}

    both, a, b = report(left + right), report(left), report(right)
    assert both == {k: a[k] + b[k] for k in both}


@few
@given(st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=20))
def test_one_hot_marks_at_most_one(spark, data):
    hot = features.one_hot(spark.createDataFrame([(v,) for v in data], "c string"), ["c"])
    assert all(sum(r) <= 1 for r in hot.collect())
    assert len(hot.columns) == len(set(data)) - 1


def test_ids_are_dense_unique_and_stable(spark):
    df = spark.range(5_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    a, b = (ids.assign_ids(f, "k", start=1) for f in (df, df.repartition(7)))
    first = {r.k: r.id_house for r in a.collect()}
    assert sorted(first.values()) == list(range(1, 5_001))
    assert first == {r.k: r.id_house for r in b.collect()}


def test_cells_match_nearest_centre(spark):
    """A point's hexagon is the one whose centre is nearest in the plane."""
    points = spark.range(400).select(
        (F.lit(3.0) + F.col("id") * 7919 % 997 / F.lit(100.0)).alias("lat"),
        (F.lit(-76.0) + F.col("id") * 104729 % 991 / F.lit(200.0)).alias("lon"),
    )
    for r in points.withColumn("cell", geo.hex_cell(F.col("lat"), F.col("lon"), 20.0)).collect():
        x = r.lon * geo.KM_PER_DEGREE * math.cos(math.radians(geo.REFERENCE_PARALLEL))
        y = r.lat * geo.KM_PER_DEGREE

        def distance(q, s):
            return math.hypot(20 * math.sqrt(3) * (q + s / 2) - x, 20 * 1.5 * s - y)

        q, s = map(int, r.cell.split(":"))
        near = [(q + dq, s + ds) for dq, ds in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1))]
        assert all(distance(q, s) <= distance(*n) + 1e-6 for n in near)


def test_way_midpoints_by_brute_force(rows):
    osm = rows("type string, id long, lat double, lon double, nodes array<long>", [
        ("node", 1, 1.0, 10.0, None), ("node", 2, 3.0, 30.0, None), ("node", 3, 2.0, 50.0, None),
        ("way", 1, None, None, [1, 2, 3, 1]), ("way", 2, None, None, [3, 99]), ("way", 3, None, None, [98]),
    ])
    assert rowset(places.way_geometry(osm)) == Counter([(1, 2.0, 30.0), (2, 2.0, 50.0)])


def test_clustering_prunes_and_keeps_rows(spark, tmp_path):
    df = spark.range(4_096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"), F.concat(F.lit("t"), "id").alias("t"))
    path = str(tmp_path / "z")
    layout.cluster(df, ["a", "b"], files=16, bits=4).write.parquet(path)
    back = spark.read.parquet(path)
    assert rowset(back) == rowset(df)
    spans = back.groupBy(F.col("_metadata.file_path")).agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).collect()
    assert len(spans) == 16 and statistics.mean(s.a for s in spans) < 32 and statistics.mean(s.b for s in spans) < 32
    texts = layout.cluster(df, ["t", "a"], files=4, bits=3)
    assert rowset(texts) == rowset(df)


def test_snapshots_publish_and_bound(spark, tmp_path):
    table = str(tmp_path / "t")
    assert snapshots.latest_version(spark, table) is None
    for v in ("2025-05-01_10-00-00", "2025-05-02_09-00-00"):
        snapshots.write_snapshot(spark.range(3).withColumn("v", F.lit(v)), table, v)
    # A folder that was written but never published is not read.
    spark.range(1).write.parquet(f"{table}/v=2025-05-03_00-00-00")
    assert snapshots.read_snapshot(spark, table).first().v == "2025-05-02_09-00-00"
    assert snapshots.load_incremental(spark, table, run_date="2025-05-01", required=["id"]).first().v == "2025-05-01_10-00-00"
    with pytest.raises(FileNotFoundError):
        snapshots.load_incremental(spark, table, run_date="2025-04-01")


def test_partitioned_write_is_repeatable(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    for _ in range(2):
        files.write_partitioned(df, str(tmp_path / "p"), ["k"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100


def test_jdbc_append_options(spark, monkeypatch):
    """The writer gets table, mode and batch size; no database is started for this."""
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: seen.update(url=url, table=table, mode=mode, properties=properties))
    files.append_jdbc(spark.range(1), "jdbc:x", "address_data", {"user": "u"})
    assert seen == {"url": "jdbc:x", "table": "address_data", "mode": "append", "properties": {"user": "u"}}
