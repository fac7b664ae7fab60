"""Fill-in-middle against a plain Python version, the offset set against lists, odd input."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import fill_in_middle as fim
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    n, h = len(tokens), sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def same(rows):
    return sorted(rows, key=repr)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, FOLDER).collect()]
    assert same(got) == same([brute(r.doc_id, r.text) for r in docs])
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_odd_rows(spark, rows):
    texts = [None, "", " ", "a", "ab\n\ncd\r\n", "x<P>y", "<", "é\U0001F600é", "<S" * 3, "<M>", "a b" * 70_000, "letters" * 30_000, "1" * 140_000]
    data = [(i, t, "clash", 7) for i, t in enumerate(texts * 8)] + [(None, "no id", "x", 1), (3, "a", "x", 1), (3, "a", "x", 1), (3, "other", "x", 1)]
    df = rows("doc_id long, text string, form string, n int", data)
    got = [tuple(r) for r in fim.middle_digests(df).collect()]
    assert same(got) == same([brute(d, t) for d, t, _, _ in data])
    assert fim.middle_digests(df.limit(0)).collect() == []


def test_outputs_are_read_back(rows):
    out = fim.fill_in_middle(rows("doc_id int, text string", [(i, f"word{i} <S two <P three <M") for i in range(60)])).collect()
    assert all(fim.restore(r.output, r.form) == f"word{r.doc_id} <S two <P three <M" for r in out)
    with pytest.raises(ValueError, match="marks"):
        fim.restore("<P>only a prefix", "psm")


@pytest.mark.parametrize(("offsets", "kind"), [
    (np.arange(0, 60_000, 40), fim.Array), (np.flatnonzero(np.random.default_rng(1).random(65_536) < 0.5), fim.Bitmap),
    (np.concatenate([np.arange(10, 20_000), np.arange(30_000, 65_536)]), fim.Runs), (np.array([65_535]), fim.Array), (np.arange(65_536), fim.Runs),
])
def test_smallest_container(offsets, kind):
    made = fim.OffsetSet.of(offsets + 3 * 65_536)
    assert isinstance(made.containers[0], kind) and made.keys == [3]
    assert made.nbytes() <= min(8192, 2 * len(offsets))
    assert [made.select(k) for k in range(len(offsets))] == (offsets + 3 * 65_536).tolist()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400_000), max_size=200), st.lists(st.tuples(st.integers(0, 390_000), st.integers(1, 9_000)), max_size=4))
def test_select(singles, runs):
    offsets = sorted(singles.union(*(range(a, a + n) for a, n in runs)))
    made = fim.OffsetSet.of(np.array(offsets, np.int64))
    assert len(made) == len(offsets)
    for k in {0, len(offsets) // 3, len(offsets) // 2, len(offsets) - 1} & set(range(len(offsets))):
        assert made.select(k) == offsets[k]
    for k in (-1, len(offsets)):
        with pytest.raises(IndexError):
            made.select(k)
