"""Packing token sequences into windows, by non-negative least squares on lengths.

1. Every document becomes its ids; what fills whole windows is cut off, so that one piece
   shorter than the window is left.
2. Shallow combinations (two or three lengths) that fill a window exactly are the columns
   of a matrix; non-negative least squares finds how often to repeat each, against the
   histogram of lengths. Repeats are rounded, but never use more pieces than there are.
3. What is left is packed greedily, still on the histogram: the longest first, each time
   with the longest that fits.
4. Pieces are numbered within their length, and the number says which repeat of which
   combination a piece belongs to.

The driver sees a histogram of at most ``window`` lengths, and combinations with repeat
counts; how many there are depends on the window, not on the corpus. Numbers are given by
sub-buckets of a length, so a length that a third of all pieces has is no large group.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import parts, small_batches, texts
from strata.plans.sizing import materialize

WINDOW = 2048
END_ID = 1
ANCHORS = 8  # frequent lengths that combinations of three are built around
SWEEPS = 60
BUCKET_ROWS = 2_000

# Characters for which both libraries surely agree on what is a letter, digit or space.
_OTHER = re.compile("[^\t\n\r -~¡-ɏ‐-‧‰-›€]")
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids as ``tokenizers`` gives them for byte_bpe_50k.json, special tokens in a text
    recognised as is its default. Plain texts go through the rank file of the same
    vocabulary, which is faster; any other text through the library itself."""

    def __init__(self):
        import public_tokenizers as public
        import tiktoken

        with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def full(self):
        """Opened by the first text that needs it."""
        import public_tokenizers as public
        from tokenizers import Tokenizer

        return Tokenizer.from_file(public.path("byte_bpe_50k.json"))

    def ids(self, text: str) -> np.ndarray:
        if _SPECIAL in text or _OTHER.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text).astype(np.uint32, copy=False)


@lru_cache(maxsize=1)
def encoder() -> Encoder:
    return Encoder()


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(documents: DataFrame, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: whole windows, then the rest."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
                       + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches):
        code = encoder()
        for batch in parts(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(code.ids(text), np.uint32(END_ID)).astype("<u4")
                for at in range(0, len(ids), window):
                    part = ids[at:at + window]
                    rows.append((doc, at, len(part), zlib.crc32(part.tobytes()), len(ids), *([part.astype(np.int32)] * with_ids)))
            cols = list(zip(*rows)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return texts(documents).mapInArrow(run, _PIECES + (", ids array<int>" if with_ids else ""))


def combinations(counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Two or three lengths that fill the window and occur; three only around the most
    frequent lengths."""
    here = np.flatnonzero(counts)
    here = here[here < window]
    have = set(here.tolist())
    found = {(a, window - a) for a in have if a <= window - a and window - a in have}
    for anchor in here[np.argsort(-counts[here], kind="stable")][:ANCHORS].tolist():
        for a in have:
            b = window - anchor - a
            if b >= a and b in have:
                found.add(tuple(sorted((anchor, a, b))))
    return sorted(found, key=lambda c: (len(c), c))


def nnls(columns: list[tuple[int, ...]], counts: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Repeats x >= 0 that make sum of |counts - columns x|^2 small, by cyclic coordinate
    descent; each step is the exact minimum in one repeat."""
    left = counts.astype(float).tolist()
    x = [0.0] * len(columns)
    for _ in range(sweeps):
        moved = 0.0
        for j, c in enumerate(columns):
            square = sum(c.count(v) for v in c)
            step = max(sum(left[v] for v in c) / square, -x[j])
            if step:
                x[j] += step
                for v in c:
                    left[v] -= step
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return np.array(x)


@dataclass(frozen=True)
class Plan:
    """Slots, sorted by ``key`` = length * SPAN + first number: piece number ``i`` of a
    length lies in repeat (i - first) // many of a combination, at ``offset`` + the rest
    times the length."""

    key: np.ndarray
    first: np.ndarray
    many: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    padding: int


SPAN = 1 << 44


def plan(histogram: dict[int, int], window: int = WINDOW) -> Plan:
    """Which pieces go where, from the number of pieces of each length."""
    counts = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    left = counts.copy()
    chosen: list[tuple[dict[int, int], int]] = []
    if left[window]:
        chosen.append(({window: 1}, int(left[window])))
        left[window] = 0
    columns = combinations(counts, window)
    repeats = nnls(columns, counts)
    for j in np.argsort(-repeats, kind="stable"):
        mix = {v: columns[j].count(v) for v in columns[j]}
        n = min(int(np.rint(repeats[j])), *(int(left[v]) // m for v, m in mix.items()))
        if n > 0:
            chosen.append((mix, n))
            for v, m in mix.items():
                left[v] -= n * m
    open_ = sorted(np.flatnonzero(left).tolist())
    while open_:
        mix, room, below = {}, window, len(open_)
        while below and room >= open_[0]:
            below = bisect_right(open_, room, 0, below)
            if not below:
                break
            v = open_[below - 1]
            mix[v] = min(int(left[v]), room // v)
            room -= mix[v] * v
            below -= 1
        n = min(int(left[v]) // m for v, m in mix.items())
        chosen.append((mix, n))
        for v, m in mix.items():
            left[v] -= n * m
        open_ = [v for v in open_ if left[v]]

    used = np.zeros(window + 1, np.int64)
    rows, sequence, padding = [], 0, 0
    for mix, n in chosen:
        at = 0
        for v, m in sorted(mix.items(), reverse=True):
            rows.append((v * SPAN + int(used[v]), int(used[v]), m, sequence, at))
            used[v] += n * m
            at += v * m
        sequence += n
        padding += n * (0 if at & (at - 1) == 0 else window - at)
    rows.sort()
    columns_ = [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5
    return Plan(*columns_, sequence, padding)


def numbered(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``_number``: 0, 1, ... within each length. Pieces are numbered in hashed buckets of
    about ``BUCKET_ROWS``, as many for a length as it has pieces for, and each bucket is
    moved up by the count of those before it. The table of buckets per length has a row for
    each length at most."""
    spark = pieces.sparkSession
    buckets = spark.createDataFrame([(v, n // BUCKET_ROWS + 1) for v, n in histogram.items()], "length long, _buckets long")
    placed = pieces.join(F.broadcast(buckets), "length").withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("_buckets")))
    before = placed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = placed.withColumn("_rank", F.row_number().over(order))
    return ranked.join(before.select("length", "_bucket", "_before"), ["length", "_bucket"]).select(
        *pieces.columns, (F.col("_rank") - 1 + F.coalesce("_before", F.lit(0))).alias("_number"))


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (a stored table: it is read twice)."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = pieces.sparkSession.sparkContext.broadcast(plan(histogram, window))
    names = [*pieces.columns, "sequence_id", "offset"]

    def run(batches):
        p = slots.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy()
            at = np.searchsorted(p.key, length * SPAN + number, "right") - 1
            rest = number - p.first[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names[:-2]]
                + [pa.array(p.sequence[at] + rest // p.many[at]), pa.array(p.offset[at] + rest % p.many[at] * length)], names=names)

    return numbered(pieces, histogram).mapInArrow(run, f"{_PIECES}, sequence_id long, offset long")


def pack(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` (see ``op6``).

    Null text is empty: such a document is its end id alone. Every row of the input is a
    document, repeated and null ids included. An empty table gives no rows. Other columns
    are ignored.
    """
    with small_batches(documents.sparkSession):
        pieces = materialize(cut(documents, window))
    return place(pieces, window)


def sequences(documents: DataFrame, packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids``: the filled windows themselves, padded unless their length is
    a power of two. A sequence has ``window`` pieces at most, so groups are bounded.
    Documents need distinct ids."""
    filled = packed.join(cut(documents, window, True).select("doc_id", "start", "ids"), ["doc_id", "start"])
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"]))
    whole = filled.groupBy("sequence_id").agg(ids.alias("ids"))
    size = F.size("ids")
    exact = size.bitwiseAND(size - 1) == 0
    return whole.select("sequence_id", F.when(exact, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(pad_id), window - size))).alias("ids"))
