"""Removal of repeated windows against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import substrings
from strata.llm.queries import QUERIES
from tests.llm.test_ngram_join import patterned

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    seen = Counter(tuple(w[i:i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [text(n) for n in (34, 35, 36, 50, 90)]
    out = []
    for _ in range(120):
        w = text(rng.randint(0, 90))
        for p in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.randint(0, len(w))
            part = p[rng.randint(0, 5):]
            w = w[:cut] + part + w[cut:]
        out.append(rng.choice([" ", "\n", "\t "]).join(w))
    out += [out[3], out[3], out[7], "a b " * 50, "x " * 100, "", None, " \n"]
    return [(i * 3, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("window,frequent,bits,fold", [(35, 5_000, 27, 200_000), (35, 3, 27, 5), (35, 0, 6, 1), (50, 10, 20, 100), (13, 5_000, 27, 100), (3, 5_000, 20, 100)])
def test_made_up(spark, monkeypatch, made, window, frequent, bits, fold):
    monkeypatch.setattr(substrings, "FREQUENT", frequent)
    monkeypatch.setattr(substrings, "BITMAP_BITS", bits)
    monkeypatch.setattr(substrings, "FOLD", fold)
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    assert rows_of(substrings.remove_repeats(df, window)) == brute(made, window)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = rows_of(QUERIES["op7_substring_dedup"](spark, folder))
    assert got == brute(rows, 35)
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got) / 2


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(50_000))
    data = [(None, long, "k"), (None, "b " + long, "k"), (1, None, "k"), (2, "p q", "k"), (2, "p q", "k"), (3, " ".join("abcdefghij" * 4), "k"),
            (3, " ".join("abcdefghij" * 4), "k"), (3, "other", "k"), (-1, "z" * 300_000 + " " + "y" * 300_000, "k")]
    df = spark.createDataFrame(data, "doc_id long, text string, kept string")
    assert rows_of(substrings.remove_repeats(df)) == brute([r[:2] for r in data], 35)
    assert substrings.remove_repeats(spark.createDataFrame([], df.schema)).collect() == []


def test_patterned_words_differ(spark):
    """Neither words nor sequences of words that a plain polynomial takes for equal."""
    x, y = patterned()
    rest = " ".join(f"w{i}" for i in range(34))
    short = " ".join(x[:64].replace("a", "l ").replace("b", "r ").split())
    data = [(1, f"{x} {rest}"), (2, f"{y} {rest}"), (3, " ".join(x[:1024])), (4, " ".join(y[:1024]) + " end"), (5, short)]
    assert rows_of(substrings.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"))) == brute(data, 35)
    a, b = (np.array([ord(c) for c in w], np.uint64) for w in (x, y))
    assert len(set(substrings._content(np.concatenate([a, b]), np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 2


def test_many_equal_rows_of_one_id(spark):
    text = " ".join(f"w{i}" for i in range(80))
    data = [(1, text)] * 3000 + [(2, text + " end"), (None, text), (1, "w1 w2")]
    assert rows_of(substrings.remove_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(6))) == brute(data, 35)
