"""Fingerprints against a plain Python version, the algebra, and odd input."""

from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import fingerprints as fp
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(seeds, text):
    units = re.split("(?<=[\n.])(?=[^\n.])", text)
    lanes = [0] * (2 * fp.KEYS + fp.SIGNS + 1)
    for u in units:
        for k in range(fp.KEYS):
            h = xxhash.xxh64(u.encode(), seed=seeds[k] & (2**64 - 1)).intdigest()
            lanes[2 * k] += h & 0xFFFFFFFF
            lanes[2 * k + 1] += h >> 32
        h = xxhash.xxh64(u.encode(), seed=seeds[fp.KEYS] & (2**64 - 1)).intdigest()
        for j in range(64):
            lanes[2 * fp.KEYS + j] += (h >> j) & 1
        lanes[-1] += 1
    return ("".join(f"{v % 2**32:08x}" for v in lanes[:2 * fp.KEYS])
            + "".join(f"{v % 2**16:04x}" for v in lanes[2 * fp.KEYS:-1]) + f"{lanes[-1]:08x}")


@pytest.fixture(scope="module")
def seeds(spark):
    return list(spark.range(1).select(*[F.xxhash64(F.lit(k)) for k in range(fp.KEYS + 1)]).first())


@pytest.mark.parametrize("bucket_bytes", [32 << 20, 40_000])
def test_against_brute_force(spark, seeds, bucket_bytes):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: r for r in fp.edited_documents(docs, bucket_bytes).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert sorted(got) == [d for d, _ in rows]
    for i, (d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == brute(seeds, text)
        assert r.edited_fingerprint == brute(seeds, edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_next == 1 if text == after else r.fingerprint != brute(seeds, after)


def test_likeness_follows_what_is_shared(spark):
    rows = QUERIES["op10_document_fingerprints"](spark, FOLDER).filter("n_chars > 2000").collect()
    assert sum(r.near_edited for r in rows) > 3 * sum(r.near_next for r in rows)


def test_combine_and_remove(spark):
    data = [(1, "a.b.\nc"), (2, "x\ny"), (3, "x\na.b.\ncy")]
    v = fp.fingerprint(spark.createDataFrame(data, "k int, text string"), ["k"])
    both = v.alias("p").join(v.alias("q"), F.expr("p.k = 1 and q.k = 2"))
    r = both.select(fp.remove(fp.combine(F.col("p.vector"), F.col("q.vector")), F.col("q.vector")) == F.col("p.vector")).first()
    assert r[0]
    swapped = spark.createDataFrame([(1, "one\ntwo\n"), (2, "two\none\n")], "k int, text string")
    assert len({tuple(r.vector) for r in fp.fingerprint(swapped, ["k"]).collect()}) == 1


def test_odd_rows(spark):
    schema = "doc_id long, text string, fingerprint int, _bucket int"
    data = [(None, "n.", 1, 1), (1, None, 1, 1), (1, "", 1, 1), (2, "é" * 3, 1, 1), (2, "é" * 3, 1, 1), (5, "a. " * 50_000, 1, 1)]
    for size in (32 << 20, 10):
        got = fp.edited_documents(spark.createDataFrame(data, schema), size).collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars) for r in got) == [
            (False, 0, 2), (True, 1, 0), (True, 1, 0), (True, 2, 3), (True, 2, 3), (True, 5, 150_000)]
        twins = [r for r in got if r.doc_id == 2]
        assert len({r.fingerprint for r in twins}) == 1 and max(r.near_next for r in twins) == 1
        last = next(r for r in got if r.doc_id == 5)  # its next is the row without id
        assert last.edited_sha256 == hashlib.sha256(("a. " * 50_000)[:75_000].encode() + b"n.").hexdigest()
    assert fp.edited_documents(spark.createDataFrame([], schema)).collect() == []
    assert fp.edited_documents(spark.createDataFrame([(7, "z", 0, 0)], schema)).first().near_next == 1
