"""Edit matching against plain dynamic programming, and planted passages."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import decontamination as dc
from strata.llm.queries import QUERIES


def table(item, text):
    """Least distance between the item and a part of the text ending at each place."""
    row = list(range(len(item) + 1))
    out = []
    for c in text:
        new = [0]
        for i, p in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        out.append(row[-1])
    return out


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=80), st.text("abc ", max_size=120))
def test_bit_parallel_distance(item, text):
    assert list(dc.Pattern(item).distances(text)) == table(item, text)


def test_nothing_within_the_budget_is_missed():
    rng = random.Random(1)
    letters = "abcdefgh "
    for _ in range(150):
        item = dc.normal("".join(rng.choice(letters) for _ in range(rng.randint(20, 120))))
        copy = list(item)
        for _ in range(rng.randint(0, dc.budget(item, 10) + 2)):
            at = rng.randrange(len(copy))
            copy[at:at + rng.randint(0, 1)] = rng.choice(["", "x", rng.choice(letters)])
        text = dc.normal("".join(rng.choice(letters) for _ in range(80)) + "".join(copy) + "".join(rng.choice(letters) for _ in range(80)))
        best = min(table(item, text))
        found = list(dc.Matcher([(1, item)], 10).find(text))
        k = dc.budget(item, 10)
        assert bool(found) == (best <= k)
        if found:
            assert min(f[3] for f in found) == best
            for _, a, b, d in found:
                assert table(item, text[a:b])[-1] == d


def test_pieces_cover_the_item():
    for m in range(1, 60):
        for k in range(0, 8):
            parts = dc.pieces("x" * m, k)
            assert sum(len(p) for _, p in parts) == m and all(p for _, p in parts)


def test_places_in_the_source():
    text = "  A\t\n b  İC "
    form, at = dc.normal(text), dc.source_places(text)
    assert len(form) == len(at) and [text[i].lower()[:1] for i, c in zip(at, form) if c != " "] == [c[:1] if c != "İ" else "i" for c in form if c != " "]


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: dc.normal(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    rows = QUERIES["op3_benchmark_decontamination"](spark, folder).collect()
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in dc.normal(t)}
    assert exact and exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        part = dc.normal(docs[r.doc_id][r.start:r.end])
        assert table(items[r.item_id], part)[-1] == r.distance <= dc.budget(items[r.item_id])


@pytest.mark.parametrize("block", [2_000_000, 30])
def test_odd_rows(spark, block):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    docs = spark.createDataFrame([
        (None, "x " + item, 0), (1, None, 0), (1, " \n", 0), (2, "y " * 40_000 + item.upper().replace(" ", "\n ") + " z" * 40_000, 0), (2, "y", 0),
        (3, item.replace("quick", "quikc"), 0), (4, item.replace("quick brown", "slow black"), 0), (5, item + " - " + item, 0)],
        "doc_id long, text string, distance int")
    bench = spark.createDataFrame([(7, item, 0), (7, item, 0), (8, None, 0), (9, "  ", 0), (10, "never seen before in any text of these", 0)], "item_id long, text string, x int")
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in dc.matches(docs, bench, block_chars=block).collect()), key=repr)
    assert got == [(2, 7, 0), (3, 7, 2), (5, 7, 0), (5, 7, 0), (None, 7, 0)]
    assert dc.matches(docs.limit(0), bench).collect() == [] == dc.matches(docs, bench.limit(0)).collect()
