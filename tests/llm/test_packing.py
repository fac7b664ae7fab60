"""Packing: every id once, no gaps, little padding; ids as the library gives them."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import packing
from strata.llm.queries import QUERIES

FULL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*FULL.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", " ", "  ", "\n", "\t", "\r\n", ".", "'s", "é", "ß", "漢", "<|endoftext|>", "<|end", "\x85", "\x1c", "\u00a0", "²", "½", "12", "A", "–"]),
                max_size=12).map("".join))
def test_ids(text):
    assert packing.encoder().ids(text).tolist() == FULL.encode(text, add_special_tokens=False).ids


def check(rows, texts, window):
    """``texts``: (doc_id, text) with distinct ids."""
    docs = {d: ids_of(t) for d, t in texts}
    parts, sequences = {}, {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        ids = docs[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    assert set(parts) == set(docs)
    for d, p in parts.items():
        at = 0
        for start, length in sorted(p):
            assert start == at
            at += length
        assert at == len(docs[d])
    padding = 0
    for p in sequences.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@pytest.mark.parametrize("rows_per_bucket", [2_000, 7])
def test_query(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(packing, "BUCKET_ROWS", rows_per_bucket)
    folder = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    padding = check(QUERIES["op6_packing"](spark, folder).collect(), texts, 2048)
    assert padding < 0.02 * sum(len(ids_of(t)) for _, t in texts)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=20))
def test_plan_places_every_piece_once(histogram):
    p = packing.plan(histogram, 32)
    filled = {}
    for length, n in histogram.items():
        number = np.arange(n)
        at = np.searchsorted(p.key, length * packing.SPAN + number, "right") - 1
        rest = number - p.first[at]
        for s, o in zip(p.sequence[at] + rest // p.many[at], p.offset[at] + rest % p.many[at] * length):
            filled.setdefault(int(s), []).append((int(o), length))
    assert sorted(filled) == list(range(p.sequences))
    for parts in filled.values():
        at = 0
        for o, length in sorted(parts):
            assert o == at
            at += length
        assert at <= 32


def test_least_squares_fits_a_histogram_it_can_explain():
    counts = np.zeros(65)
    for combination, n in {(10, 54): 300, (20, 44): 100, (4, 20, 40): 50}.items():
        for v in combination:
            counts[v] += n
    columns = packing.combinations(counts, 64)
    x = packing.nnls(columns, counts)
    fit = np.zeros(65)
    for c, n in zip(columns, x):
        for v in c:
            fit[v] += n
    assert np.abs(fit - counts).max() < 1 and (x >= 0).all()


def test_filled_sequences(spark):
    texts = [(i, f"word{i} " * (i % 9)) for i in range(40)] + [(50, None), (51, "x y z " * 200)]
    df = spark.createDataFrame([(*t, 0) for t in texts], "doc_id long, text string, start int")
    packed = packing.pack(df, 64)
    rows = packed.collect()
    check(rows, texts, 64)
    ids = {d: ids_of(t) for d, t in texts}
    want = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        want.setdefault(r.sequence_id, []).extend(ids[r.doc_id][r.start:r.start + r.length])
    for r in packing.sequences(df, packed, 64).collect():
        n = len(want[r.sequence_id])
        assert r.ids == want[r.sequence_id] + [0] * (0 if n & (n - 1) == 0 else 64 - n)


def test_odd_rows(spark):
    schema = "doc_id long, text string, offset int"
    data = [(None, None, 1), (1, "", 1), (1, "a b", 1), (1, "a b", 1), (2, "word " * 30_000, 1)]
    rows = packing.pack(spark.createDataFrame(data, schema)).collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(t)) for _, t, _ in data)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(spark.createDataFrame([], schema)).collect() == []
