"""Components against brute force, on given tables and on made-up near copies."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from strata.llm import ngram_join
from strata.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=4, percent=85):
    """Sizes, and the smallest id reachable, by comparing all that share a shingle."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lists = {}
    for i, (d, s) in enumerate(sets):
        near = {j for g in s for j in lists.get(g, ())} if d is not None else ()
        for j in near:
            t = sets[j][1]
            if root(i) != root(j) and 100 * len(s & t) >= percent * len(s | t):
                parent[root(i)] = root(j)
        if d is not None:
            for g in s:
                lists.setdefault(g, []).append(i)
    low = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted(((d, len(s), None if d is None else low[root(i)] if s else d) for i, (d, s) in enumerate(sets)), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def family(seed, n, words, edits, vocab):
    """Copies of one text with up to ``edits`` words replaced."""
    rng = random.Random(seed)
    base = [rng.choice(vocab) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def made():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    out = []
    for s in range(25):
        out += family(s, rng.choice([2, 3, 12, 30]), rng.choice([5, 7, 9, 12, 20, 40, 90, 200]), 3, vocab)
    out += [" ".join(rng.choice(vocab) for _ in range(rng.randint(10, 150))) + " " + passage for _ in range(80)]
    out += [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    out += ["", " \n", "one", "ONE", "One two", "one two three four", "one two three four", "İ K"]
    rng.shuffle(out)
    return [(i * 7 - 50, t) for i, t in enumerate(out)] + [(3_000_000, None)]


@pytest.mark.parametrize("block,limit", [(1_500, None), (3, None), (3, 0), (1_500, 60)])
def test_made_up(spark, monkeypatch, made, block, limit):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    if limit is not None:
        monkeypatch.setattr(ngram_join, "boundary", lambda *_: limit)
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    assert rows_of(ngram_join.jaccard_components(df)) == brute(made)


def test_other_length_and_threshold(spark, made):
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert rows_of(ngram_join.jaccard_components(df, 5, 80)) == brute(made, 5, 80)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows_of(QUERIES["op4_ngram_jaccard_join"](spark, folder)) == brute(rows)


def test_odd_rows(spark):
    text = "a b c d e f g h i j"
    data = [(None, text, 1), (None, None, 1), (4, text, 1), (4, "x y", 1), (2, text.upper(), 1), (9, text, 1), (9, text, 1),
            (11, "word " * 60_000, 1), (12, "z" * 200_000 + " a b c d e", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, component_id int")
    assert rows_of(ngram_join.jaccard_components(df)) == sorted([
        (None, 7, None), (None, 0, None), (4, 7, 2), (4, 1, 4), (2, 7, 2), (9, 7, 2), (9, 7, 2), (11, 1, 11), (12, 3, 12)], key=repr)
    assert ngram_join.jaccard_components(spark.createDataFrame([], df.schema)).collect() == []


def test_boundary_weighs_both_sides():
    assert ngram_join.boundary({}, 1.0, 85) == 0
    sizes = {n: 10 for n in range(6, 200)}
    assert ngram_join.boundary(sizes, 0.0, 85) < ngram_join.boundary(sizes, 20.0, 85) < 200


def patterned():
    """Two words of 1,024 bytes that a polynomial over their bytes, modulo a power of two,
    takes for one."""
    x = "a"
    while len(x) < 1024:
        x += x.translate({97: "b", 98: "a"})
    return x, x.translate({97: "b", 98: "a"})


def test_patterned_words_differ(spark):
    x, y = patterned()
    data = [(1, f"{x} {x} {x} z"), (2, f"{y} {y} {y} z"), (3, f"{x} {x} {x} z"), (4, x), (5, y)]
    got = rows_of(ngram_join.jaccard_components(spark.createDataFrame(data, "doc_id long, text string")))
    assert got == brute(data) and [r[2] for r in got] == [1, 2, 1, 4, 5]


@pytest.mark.parametrize("percent", [30, 80, 85, 100])
def test_bitmaps_rule_out_only_strangers(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64)
        sets += [np.unique(np.concatenate([base[rng.random(len(base)) < share], base[:1]])) for share in rng.uniform(0.3, 1, int(rng.integers(1, 6)))]
    sizes, bits = [len(s) for s in sets], [ngram_join.bitmap(s) for s in sets]
    enough = lambda i, j, shared: (100 + percent) * shared >= percent * (sizes[i] + sizes[j])
    others = lambda i: (j for j in range(len(sets)) if j != i)
    got = ngram_join.may_link(sizes, bits, percent).tolist()
    assert got == [any(enough(i, j, ngram_join.most_shared(bits[i], sizes[i], bits[j], sizes[j])) for j in others(i)) for i in range(len(sets))]
    assert all(g for i, g in enumerate(got) if any(enough(i, j, len(np.intersect1d(sets[i], sets[j]))) for j in others(i)))


@pytest.mark.parametrize("part", [2_000, 7])
def test_pairs_of_a_crowded_list(spark, monkeypatch, part):
    monkeypatch.setattr(ngram_join, "LIST_PART", part)
    rng = random.Random(part)
    rows = [(rng.choice([1, 1, 1, 2]), i, rng.randint(20, 60), rng.randint(0, 6), rng.randint(0, 150), rng.choice([None, 5, 6])) for i in range(200)]
    df = spark.createDataFrame(rows, "key long, set_id long, n int, at int, comp long, spot long")
    want = {(min(x[1], y[1]), max(x[1], y[1])) for i, x in enumerate(rows) for y in rows[:i]
            if x[0] == y[0] and x[4] != y[4] and (x[5] is None or x[5] != y[5]) and 185 * min(x[2] - x[3], y[2] - y[3]) >= 85 * (x[2] + y[2])}
    got = [tuple(r) for r in ngram_join.list_pairs(df, 85).collect()]
    assert len(got) == len(set(got)) and set(got) == want
