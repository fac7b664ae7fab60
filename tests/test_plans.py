"""Physical plans: what is pushed, pruned, broadcast, and kept out of Python."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from catalog.base import Tables
from catalog.flows import KEYED_ROWS
from strata.config import DEFAULTS, Settings
from strata.operators import aggregates, dedup, features, filters, places, quality, upsert
from strata.plans import flows
from strata.sources import snapshots

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark):
    text = plan(dedup.latest_per_key(Tables(spark, FOLDER).view("v_batch")))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", text)]
    # The plan prints the last step first: final limit, exchange, partial limit.
    assert len(limits) == 2 and limits[0] < text.index("Exchange") < limits[1]


def test_report_is_one_scan(spark):
    text = plan(quality.quality_report(Tables(spark, FOLDER).table("orders"), {"o_totalprice": (0, 1)}, duplicates=False))
    assert text.split("Initial Plan")[0].count("FileScan") == 1 and "hashpartitioning" not in text


def test_duplicates_shuffle_hashes_and_compare_only_repeats(spark, monkeypatch):
    written = []
    keep = quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df: written.append(plan(df)) or keep(df))
    text = plan(quality.duplicate_rows(Tables(spark, FOLDER).table("orders")))
    # What is counted: hashes alone. Each exchange is fed by an aggregate of its task.
    assert len(written) == 1 and written[0].count("Exchange hashpartitioning") == 2
    for step in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", written[0]):
        assert all(re.match(r"(_h|when|if|CASE)?", c.strip()) and "o_" not in c for c in step.split(","))
    counting = [line for line in written[0].splitlines() if "HashAggregate" in line]
    assert counting and not any("o_comment" in line or "o_clerk" in line or "o_orderpriority" in line for line in counting)
    # Whole rows: only behind the join with hashes that occur again.
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "SortMergeJoin" not in text


def test_counts_need_no_row_shuffle(spark):
    text = plan(quality.null_counts(Tables(spark, FOLDER).table("orders")))
    assert "SinglePartition" in text and "hashpartitioning" not in text


def test_enrich_broadcasts_a_small_side_and_not_a_large_one(spark):
    t = Tables(spark, FOLDER)
    counts = places.cell_counts(t.view("v_poi"), 20.0)
    listings = t.table("orders").select((F.col("o_custkey") % 9).alias("lat"), (F.col("o_orderkey") % 70).alias("lon"))
    assert "BroadcastHashJoin" in plan(places.enrich_poi(listings, counts, 20.0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = places.enrich(listings.withColumn("hex_id", F.col("lat").cast("string")), counts, "hex_id", broadcast_bytes=0)
        assert "SortMergeJoin" in plan(wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_upsert_does_not_shuffle_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").cast("string").alias("url"), F.lit(1).alias("fecha")).write.parquet(path)
    target = spark.read.parquet(path)
    text = plan(upsert.upsert(target, spark.createDataFrame([("3", 2)], "url string, fecha int")))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_iqr_filter_reaches_the_scan(spark):
    text = plan(filters.iqr_filter(Tables(spark, FOLDER).table("events").select("event_id", "value"), "value", written=True))
    pushed = re.search(r"PushedFilters: \[([^\n]*)", text).group(1)
    assert "GreaterThanOrEqual(value" in pushed and "LessThanOrEqual(value" in pushed


def test_gold_filters_before_removing_equal_rows(spark):
    t = Tables(spark, FOLDER)
    listed = t.table("orders").select(F.col("o_totalprice").alias("precio"), F.col("o_custkey").cast("double").alias("area_construida"))
    text = plan(features.gold_dataset(listed))
    assert text.index("HashAggregate") < text.index("Filter") and "GreaterThanOrEqual(o_totalprice" in text


def test_summary_reads_two_columns(spark):
    text = plan(aggregates.count_by(Tables(spark, FOLDER).table("lineitem"), "l_returnflag"))
    assert "ReadSchema: struct<l_returnflag:string>" in text


def test_newest_batch_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "b")
    spark.range(10).select("id", F.concat(F.lit("b"), F.col("id") % 3).alias("batch_id")).write.partitionBy("batch_id").parquet(path)
    df = snapshots.newest_batch(spark, path)
    assert "batch_id" in re.search(r"PartitionFilters: \[([^\n]*?)\]", plan(df)).group(1) and df.count() == 3


def test_no_python_outside_pages(spark):
    import catalog

    for name in ("dedup_latest", "join_poi_cell", "dq_report", "upsert_latest_wins", "feat_label_encode", "geo_hex_cell", "json_explode_outer"):
        text = plan(catalog.QUERIES[name](spark, FOLDER))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_few_bytes_to_parse_are_spread_over_all_cores(spark):
    df = spark.range(1000, numPartitions=2)
    cores = spark.sparkContext.defaultParallelism
    count = lambda size: flows.spread(df, size).rdd.getNumPartitions()
    assert count(0) == 1 and count(600 * 1024) == 2 and count(100 << 20) == 4 * cores
    assert flows.spread(df, cores * DEFAULTS.parse_bytes) is df


def test_silver_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = Tables(spark, FOLDER).sql(KEYED_ROWS).withColumn("unidades", F.lit("[]"))
    done = flows.silver(spark, rows, spark.createDataFrame([], "hex_id string, hospital long, mall long, park long, school long"), path, "v1",
                        settings=Settings(least_parse_bytes=10_000))
    assert len(done.rows.inputFiles()) > 8
