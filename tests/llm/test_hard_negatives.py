"""Hard negatives against a plain Python version, the packed products, odd input."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import hard_negatives as hn
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, positives=5, negatives=10):
    seen = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        seen[i, int(label), tuple(math.floor(256 * x) for x in v)] = None
    found = set()
    for anchor in [k for k in seen if k[0] % 100 == 0]:
        near, far = set(), set()
        for i, label, v in seen:
            if i != anchor[0] or label != anchor[1]:
                if len(v) == len(anchor[2]):
                    (near if label == anchor[1] else far).add((-sum(x * y for x, y in zip(v, anchor[2])), i))
        for p, pid in sorted(near)[:positives]:
            window = sorted((n, nid) for n, nid in far if 30 * -p <= 100 * -n <= 90 * -p)
            found |= {(anchor[0], pid, r, nid, -p, -n) for r, (n, nid) in enumerate(window[:negatives], 1)}
    return sorted(found)


def mined(df, **options):
    got = [tuple(r) for r in hn.mine(df, **options).collect()]
    return sorted(got)


def test_query_against_brute_force(spark):
    given_ = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, FOLDER).collect())
    assert got == brute(given_) and got


def test_blocks_of_anchors(rows):
    draw = random.Random(3)
    data = [(i, draw.randrange(3), [draw.randrange(-9, 10) / 4 for _ in range(6)]) for i in range(0, 3000, 5)]
    df = rows(SCHEMA, data).repartition(7)
    assert mined(df) == brute(data)
    assert mined(df, block=30) == brute(data)  # several blocks
    assert mined(df, positives=2, negatives=40) == brute(data, 2, 40)


def test_odd_rows(rows):
    nan, inf = float("nan"), float("inf")
    plain = [(i, i % 2, [1.0, (i % 9) / 8]) for i in range(1, 60)]
    odd = [
        (None, 1, [1.0, 1.0]), (100, None, [1.0, 1.0]), (100, 1, None), (100, 1, [1.0, None]), (100, 1, [nan, 1.0]), (100, 1, [inf, 1.0]),
        (100, 1, []), (200, 0, []), (201, 0, []), (202, 1, []), (100, 1, [1.0, 0.5]), (100, 1, [1.0, 0.5]), (100, 0, [0.5, -0.0]),
        (100, 0, [0.5, 0.0]), (300, 1, [1.0, 1.0, 1.0]), (301, 1, [1.0, 1.0, 1.0]), (302, 0, [0.5, 0.5, 0.5]), (5, 1, [1.0, 0.25]), (-700, 1, [-1.0, 0.0]),
    ]
    equal = [(900 + j, 1 + j % 2, [0.5, 0.5]) for j in range(200)] * 2
    data = plain + odd + equal
    df = rows(SCHEMA + ", rank string, score int", [(*r, "clash", 1) for r in data])
    assert mined(df.repartition(5)) == brute(data)
    assert mined(df.limit(0)) == [] and mined(rows(SCHEMA, [(1, 1, [1.0])])) == []


def test_components_of_any_size(rows):
    draw = random.Random(5)
    for scale in (1e3, 1e5, 2e6):
        data = [(i * 20, draw.randrange(2), [scale * draw.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
        assert mined(rows(SCHEMA, data)) == brute(data)
    with pytest.raises(Exception, match="int|Overflow|large"):
        mined(rows(SCHEMA, [(100, 1, [1e12]), (101, 1, [1e12]), (102, 2, [5e11])]))


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 30), st.integers(1, 9), st.sampled_from([1, 3, 300, 70_000, 10**8, 10**14]), st.integers(0, 2**32))
def test_packed_scores_are_exact(n, dims, size, seed):
    draw = random.Random(seed)
    anchors, rows = ([[draw.randint(-size, size) for _ in range(dims)] for _ in range(k)] for k in (4, n))
    got = hn.scores(np.array(anchors, float), np.array(rows, float))
    assert got.tolist() == [[sum(x * y for x, y in zip(a, r)) for r in rows] for a in anchors]
