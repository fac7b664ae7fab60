"""Fill-in-middle: cut a text at two token boundaries and move the middle to the end.

Where tokens end is kept as a compressed set of offsets, built and searched like a Roaring
bitmap: offsets are split by their high 16 bits into containers, each of which is the
smallest of a sorted array, a bitmap of 65,536 bits, or a list of runs. Cumulative
cardinalities lead to the container that holds the k-th offset, and a select within that
container (by index, by counted bits, by run lengths) returns it. Both cuts are such selects;
the tokens themselves are never made.

A token is a run of letters A-Z or a-z, or any other single code point.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import parts, texts

CHUNK = 1 << 16  # offsets of one container
ARRAY_MOST = 4096  # an array of more than these takes more room than a bitmap
MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
PLAIN_PERCENT = 10  # texts left as they are
SPM_PERCENT = 20  # of the others: suffix first


@dataclass(frozen=True)
class Array:
    """Sorted low halves."""

    low: np.ndarray

    def select(self, k: int) -> int:
        return int(self.low[k])

    def nbytes(self) -> int:
        return 2 * len(self.low)


@dataclass(frozen=True)
class Bitmap:
    """65,536 bits as words of 64, with the bits set before each word."""

    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> Bitmap:
        bits = np.zeros(CHUNK, np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return cls(words, np.concatenate([[0], np.cumsum(counts)[:-1]]))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        word, left = int(self.words[at]), k - int(self.before[at])
        for _ in range(left):
            word &= word - 1  # drop the lowest bit
        return at * 64 + (word & -word).bit_length() - 1

    def nbytes(self) -> int:
        return self.words.nbytes


@dataclass(frozen=True)
class Runs:
    """First offset of each run, and how many offsets lie before it."""

    starts: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> Runs:
        at = np.flatnonzero(np.concatenate([[True], np.diff(low.astype(np.int64)) != 1]))
        return cls(low[at], at)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])

    def nbytes(self) -> int:
        return 4 * len(self.starts)


def container(low: np.ndarray) -> Array | Bitmap | Runs:
    """The smallest container of sorted distinct low halves (``uint16``)."""
    runs = 1 + int(np.count_nonzero(np.diff(low.astype(np.int64)) != 1))
    if 4 * runs < min(2 * len(low), CHUNK // 8):
        return Runs.of(low)
    return Array(low) if len(low) <= ARRAY_MOST else Bitmap.of(low)


class OffsetSet:
    """Ascending offsets in containers; only containers with offsets are kept."""

    def __init__(self, keys: Sequence[int], containers: Sequence[Array | Bitmap | Runs], sizes: Sequence[int]):
        self.keys, self.containers = list(keys), list(containers)
        self.before = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)

    @classmethod
    def of(cls, offsets: np.ndarray) -> OffsetSet:
        high = offsets >> 16
        at = np.flatnonzero(np.diff(high, prepend=-1)) if len(offsets) else np.zeros(0, np.int64)
        cuts = np.split(offsets, at[1:]) if len(offsets) else []
        return cls([int(high[a]) for a in at], [container((c & (CHUNK - 1)).astype(np.uint16)) for c in cuts], [len(c) for c in cuts])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The ``k``-th offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (self.keys[at] << 16) + self.containers[at].select(k - int(self.before[at]))

    def nbytes(self) -> int:
        return sum(c.nbytes() for c in self.containers)


def token_ends(text: str) -> OffsetSet:
    """Where tokens end, in code points."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    lower = points | np.uint32(0x20)
    letter = (lower >= 97) & (lower <= 122) & (points < 128)
    joined = letter[:-1] & letter[1:]
    return OffsetSet.of(np.flatnonzero(np.concatenate([~joined, [True]])[:len(points)]) + 1)


def draws(doc_id: int | None, seed: int = 1) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that depend on nothing but the id; no id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))  # type: ignore[return-value]


def cut(text: str, a: int, b: int, form: str) -> str:
    """The text with its middle ``text[a:b]`` last: prefix, suffix, middle (``psm``) or
    suffix, prefix, middle (``spm``)."""
    p, s, m = MARKS
    first = (p, text[:a], s, text[b:]) if form == "psm" else (s, text[b:], p, text[:a])
    return "".join((*first, m, text[a:b]))


def restore(output: str, form: str) -> str:
    """The text that ``cut`` was given."""
    if form == "plain":
        return output
    p, s, m = MARKS
    first, second = (p, s) if form == "psm" else (s, p)
    if not output.startswith(first):
        raise ValueError(f"{form} output does not start with {first}")
    one, found, rest = output[len(first):].partition(second)
    two, found2, middle = rest.partition(m)
    if not (found and found2):
        raise ValueError(f"{form} output without its marks")
    return one + middle + two if form == "psm" else two + middle + one


def transform(doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
    """Number of tokens, form, code points of prefix and middle, and the output."""
    ends = token_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends.select(k - 1) if k else 0 for k in (one, two))
    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    return n, form, a, b - a, cut(text, a, b, form)


_I64, _STR = pa.int64(), pa.string()
_OUT = pa.schema([("doc_id", _I64), ("n", _I64), ("form", _STR), ("prefix_chars", _I64), ("middle_chars", _I64), ("output", _STR)])


def fill_in_middle(documents: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, one row per row.

    A null text is empty and stays plain, as do texts that hold a mark. Rows are judged each
    on its own, by id and text: equal rows get equal output, rows that share an id share
    their draws, and a null id draws as an empty one. An empty table gives none. Whole texts
    are cut, however long; other columns are ignored.
    """
    def run(batches):
        for batch in parts(batches):
            rows = [(d, *transform(d, t)) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)

    return texts(documents).mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


_DIGEST = pa.schema([*(f for f in _OUT if f.name != "output"), ("output_sha256", _STR), ("restored_sha256", _STR)])


def middle_digests(documents: DataFrame) -> DataFrame:
    """``fill_in_middle`` with digests of the output, and of the text read back from it."""
    def run(batches):
        for batch in parts(batches):
            if not batch.num_rows:
                continue
            outputs, forms = batch.column("output").to_pylist(), batch.column("form").to_pylist()
            digests = [hashlib.sha256(o.encode()).hexdigest() for o in outputs]
            restored = [hashlib.sha256(restore(o, f).encode()).hexdigest() for o, f in zip(outputs, forms)]
            kept = [batch.column(f.name) for f in _OUT if f.name != "output"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(digests, _STR), pa.array(restored, _STR)], schema=_DIGEST)

    made = fill_in_middle(documents).select(*[F.col(f.name) for f in _OUT])
    return made.mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
