"""Counts against the library itself, on given, random and odd texts."""

from __future__ import annotations

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import token_counts as tc
from strata.llm.queries import QUERIES

MODEL = sentencepiece.SentencePieceProcessor(model_file=tc.model_path())
COUNTER = tc.Counter(tc.model_path(), {"the": 1})


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["the", " ", "  ", "\n", "\t", "\r", ".", ",", "...", ".,", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "é", "ß", "漢字", "🙂", "\x00", "a",
                                 "word", "12", "e.g.", "\u00a0", "\u3000", "'s"]), max_size=14).map("".join))
def test_any_text(text):
    assert COUNTER.count(text) == len(MODEL.encode(text))


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(tc, "CACHE", 3)
    counter = tc.Counter(tc.model_path(), {"the": 1})
    text = " ".join(f"w{i} the.\nX{i}" for i in range(50))
    assert counter.count(text) == len(MODEL.encode(text))
    assert len(counter.words) <= 4 and len(counter.parts) <= 3


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, folder).collect()}
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        r, text = got.pop(d.doc_id), d.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(MODEL.encode(text)))
        assert r.over_limit == (r.n_tokens > 4096)
    assert not got


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(tc, "TALLY", 2)
    data = [(None, None, 1), (1, "", 1), (1, "a b", 1), (1, "a b", 1), (2, "z" * 100_000, 1), (3, "one two " * 20_000, 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_tokens int")
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in tc.count_tokens(df).collect())
    assert got == sorted((repr(d), len((t or "").encode()), n := len(MODEL.encode(t or "")), n > 4096) for d, t, _ in data)
    assert tc.count_tokens(df.limit(0)).collect() == []
