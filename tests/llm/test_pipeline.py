"""The pipeline stage by stage, each on its own input, and as a whole."""

from __future__ import annotations

import pytest

import __spark_entry__
import corpus_pipeline
from strata.llm import decontamination as dc
from strata.llm import pii
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_packing import check as check_packed

FOLDER = "/root/testdata/sf0.01"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def by_id(df):
    rows = df.collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_order_of_stages():
    assert list(STAGE) == ["language", "near_copies", "decontamination", "personal_data", "packing"]
    assert "pipeline" in __spark_entry__.queries() and corpus_pipeline.ORACLE_SQL is None


def test_language_keeps_prose(spark, docs):
    kept, given = by_id(STAGE["language"](spark, docs, FOLDER)), by_id(docs)
    assert len(kept) >= 0.98 * len(given)
    assert all(r.text == given[d].text and r.source == given[d].source for d, r in kept.items())


def test_near_copies_against_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {d for d, n, c in components(rows, 5, 80) if d == c}
    got = by_id(STAGE["near_copies"](spark, docs, FOLDER))
    assert set(got) == want and len(want) < len(rows)
    assert STAGE["near_copies"](spark, docs, FOLDER).columns == docs.columns


def test_near_copies_where_ids_repeat(spark):
    long = lambda w: " ".join(f"{w}{i}" for i in range(60))
    a, b, c, e = map(long, "abce")
    data = [(7, a), (8, a + " end"), (7, b), (3, b + " end"),  # two groups share an id
            (9, c), (9, a + " more"),  # a clean text under the id of a copy
            (5, e + " y"), (5, e + " x"), (5, e + " x"), (6, e),  # copies under one id, equal rows
            (11, ""), (11, None), (-1, a + " z"), (None, a + " z")]
    df = spark.createDataFrame([(d, t, "k") for d, t in data], "doc_id long, text string, _copy string").repartition(3)
    got = STAGE["near_copies"](spark, df, FOLDER)
    assert got.columns == df.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, [
        (-1, a + " z"), (3, b + " end"), (9, c), (5, e + " x"), (11, ""), (11, None), (None, a + " z")]))
    alone = spark.createDataFrame([(7, a), (8, a + " end"), (7, b), (3, b + " end")], "doc_id long, text string")
    assert {tuple(r) for r in STAGE["near_copies"](spark, alone, FOLDER).collect()} == {(7, a), (3, b + " end")}


def test_decontamination(spark, docs):
    items = [dc.normal(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept, given = by_id(STAGE["decontamination"](spark, docs, FOLDER)), by_id(docs)
    exact = {d for d, r in given.items() if any(i in dc.normal(r.text) for i in items)}
    assert exact and not exact & set(kept)
    matcher = dc.Matcher(list(enumerate(items)), dc.PERCENT)
    assert set(kept) == {d for d, r in given.items() if not list(matcher.find(dc.normal(r.text)))}


def test_personal_data(spark, docs):
    got, given = by_id(STAGE["personal_data"](spark, docs, FOLDER)), by_id(docs)
    assert set(got) == set(given)
    changed = 0
    for d, r in got.items():
        assert r.text == pii.redacted(given[d].text) and r.n_chars == len(r.text)
        assert not pii.plain_spans(r.text)
        changed += r.text != given[d].text
    assert changed > 20


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check_packed(out, texts, 2048)


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, extra array<int>"
    text = "the house of the people stands by the river in the town near the old mill"
    data = [(None, text, "en", None, 1, "x", [1]), (None, None, None, "s", None, "x", None), (1, text, "en", "s", 3, "x", [1]), (1, text, "en", "s", 3, "x", [1]),
            (2, "", "en", "s", 0, "x", [1]), (3, "le chat et le chien de la maison sont dans le jardin avec les enfants", "fr", "s", 1, "x", [1]), (4, text, "en", "t", 3, "x", [1])]
    df = spark.createDataFrame(data, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, FOLDER).columns == df.columns
        assert stage(spark, df.limit(0), FOLDER).collect() == []
    kept = STAGE["near_copies"](spark, df, FOLDER).collect()
    assert sorted(repr(r.doc_id) for r in kept) == ["1", "2", "3", "None", "None"]
    clean = STAGE["decontamination"](spark, df, FOLDER).collect()
    assert sorted(map(repr, map(tuple, clean))) == sorted(map(repr, data))  # ``_row`` keeps its values
    assert len(STAGE["personal_data"](spark, df, FOLDER).collect()) == len(data)
    assert all(r.text for r in STAGE["language"](spark, df, FOLDER).collect())
    assert STAGE["packing"](spark, df.limit(0), FOLDER).collect() == []
