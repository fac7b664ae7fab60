"""Exact quantiles however poor the sketch, in rounds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import quantiles

PS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
NAMES = [f"p{i}" for i in range(len(PS))]


def expected(values):
    return [float(np.quantile(np.array(values, float), p)) for p in PS]


def test_three_rounds_on_one_group_of_distinct_values(spark, monkeypatch):
    done = []
    narrow = quantiles.narrow
    monkeypatch.setattr(quantiles, "narrow", lambda *a: done.append(narrow(*a)) or done[-1])
    n = 400_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("v"))
    # A sketch of ten values: slivers of two fifths of all rows.
    row = quantiles.group_quantiles(df, [], "v", PS, NAMES, accuracy=10, sliver=3).first()
    assert list(row) == pytest.approx(expected(np.arange(n)), rel=1e-12)
    assert done[0][1] >= 3
    left = done[0][0].groupBy("_i").count().collect()
    assert len(left) == len(PS) and max(r["count"] for r in left) <= 3


@pytest.mark.parametrize("sliver", [1, 2, 5, 50, 10_000])
def test_groups(spark, sliver):
    rng = np.random.default_rng(5)
    groups = {None: rng.normal(size=3000), "hot": rng.integers(0, 9, 6000) / 4, "one": [7.5], "two": [1.0, 2.0],
              "ends": [-1e300] * 400 + [1e300] * 401, "near": 1 + np.arange(500) * 1e-15}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("hot", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r.g: list(r)[1:] for r in quantiles.group_quantiles(df, ["g"], "v", PS, NAMES, accuracy=20, sliver=sliver).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(expected(vs), rel=1e-12), g


def test_nothing_to_rank(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert quantiles.group_quantiles(empty, ["g"], "v", [0.5], ["m"], sliver=1).collect() == []
    assert quantiles.quantile_row(empty, "v", [0.5]) is None


def test_no_window_and_no_group_in_one_task(spark):
    df = spark.range(100_000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("v"))
    found = quantiles.group_quantiles(df, ["g"], "v", [0.5], ["m"], sliver=10)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text
    assert {r.g: r.m for r in found.collect()} == {g: float(np.median(np.arange(g, 100_000, 7))) for g in range(7)}
