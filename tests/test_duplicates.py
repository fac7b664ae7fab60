"""Duplicate rows: hashes first, whole rows where hashes repeat."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators import quality


def counts(df):
    return tuple(quality.duplicate_rows(df).first())


def plain(df):
    return df.count(), df.count() - df.distinct().count()


@pytest.mark.parametrize("copies", [1, 2, 40])
def test_against_distinct(spark, copies):
    df = spark.range(500).select((F.col("id") % 60).alias("a"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("b c"))
    df = df.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_")).drop("_").repartition(5)
    assert counts(df) == plain(df)


def test_nulls_in_other_places_are_other_rows(rows):
    df = rows("a string, b string, c array<int>", [("x", None, None), (None, "x", None), (None, None, None), (None, None, None), ("x", None, [None, 1]),
                                                   ("x", None, [1, None]), ("", None, None), (None, "", None)])
    assert counts(df) == (8, 1)


def test_numbers_that_are_equal(rows):
    nan = float("nan")
    df = rows("v double, w float", [(0.0, 0.0), (-0.0, 0.0), (nan, 1.0), (nan, 1.0), (None, None), (1.0, nan)])
    assert counts(df) == (6, 2)


def test_rows_that_share_both_hashes_are_compared(rows, monkeypatch):
    monkeypatch.setattr(quality, "row_hashes", lambda df, names: [F.lit(7).cast("long").alias(n) for n in names])
    df = rows("a int, b string", [(i % 9, "x") for i in range(50)] + [(None, "x"), (None, None)])
    assert counts(df) == plain(df) == (52, 41)


def test_columns_the_hash_cannot_read(spark):
    df = spark.sql("""select * from values (map('a', 1, 'b', 2), array(map(1, 2)), 1),
        (map('b', 2, 'a', 1), array(map(1, 2)), 1), (map('a', 1), array(map(1, 2)), 1) as t(m, n, v)""")
    assert counts(df) == (3, 1)


def test_names_that_clash_and_nothing_at_all(rows):
    assert counts(rows("_h1 int, n int, _H2 int, kept int", [(1, 2, 3, 4), (1, 2, 3, 4), (1, 2, 3, 5)])) == (3, 1)
    empty = rows("a int", [])
    assert counts(empty) == (0, 0)
    got = {(r.metric, r.column): r.value for r in quality.quality_report(empty).collect()}
    assert got == {("total_rows", ""): 0, ("duplicate_rows", ""): 0, ("null_count", "a"): 0}


def test_a_third_of_all_rows_is_one(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"), F.lit("long text " * 20).alias("t"))
    assert counts(df) == (60_000, 19_999)
