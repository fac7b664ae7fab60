"""Benchmark decontamination by pigeonhole edit matching.

An item of ``m`` characters may differ by ``k`` edits (``percent`` of m). Cut into k + 1
pieces, at least one piece survives k edits unchanged, and stands within k places of where
it belongs. So exact hits of pieces give all candidate regions, and Myers' bit-parallel
algorithm decides each of them: one step for a character of the region, however long the
item. Nothing within the budget is missed.

Items and texts are compared in lower case, with every run of white space as one blank.
The benchmark is searched for in blocks of a bounded number of characters; the texts are
read once for each block and never shuffled.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty, parts, texts

PERCENT = 5  # edits allowed, of the characters of an item
BLOCK_CHARS = 2_000_000  # characters of benchmark text in one broadcast


def lowered(text: str) -> str:
    """Lower case of the same length; the few characters that would grow stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normal(text: str) -> str:
    return " ".join(lowered(text).split())


def source_places(text: str) -> list[int]:
    """For every character of ``normal(text)``, its place in ``text``."""
    places, gap = [], False
    for i, c in enumerate(text):
        if c.isspace():
            gap = bool(places)
            continue
        if gap:
            places.append(places[-1] + 1)  # the blank stands for the white space behind
            gap = False
        places.append(i)
    return places


def budget(item: str, percent: int = PERCENT) -> int:
    return len(item) * percent // 100


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of about equal length with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


class Pattern:
    """An item as the bit vectors of Myers' algorithm."""

    def __init__(self, text: str):
        self.length = len(text)
        self.bits: dict[str, int] = {}
        for i, c in enumerate(text):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def distances(self, text: str):
        """For each character of ``text``: the least distance between the item and a part
        of ``text`` that ends there."""
        m, get = self.length, self.bits.get
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score = full, 0, m
        for c in text:
            eq = get(c, 0)
            vertical = eq | minus
            horizontal = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (full & ~(horizontal | plus))
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = up << 1 & full, down << 1 & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
            yield score


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.items = [(i, t, budget(t, percent)) for i, t in items]
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, k) in enumerate(self.items):
            for offset, piece in pieces(text, k):
                found.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def regions(self, text: str):
        """(item, begin, end) of the places to look at, one for each group that overlaps."""
        spans: dict[int, list[tuple[int, int]]] = {}
        for last, (length, uses) in self.automaton.iter(text):
            for at, offset in uses:
                _, item, k = self.items[at]
                begin = last - length + 1 - offset
                spans.setdefault(at, []).append((max(0, begin - k), min(len(text), begin + len(item) + k)))
        for at, found in spans.items():
            found.sort()
            begin, end = found[0]
            for b, e in found[1:]:
                if b <= end:
                    end = max(end, e)
                else:
                    yield at, begin, end
                    begin, end = b, e
            yield at, begin, end

    def find(self, text: str):
        """(item id, begin, end, distance) in the normal text; of ends next to each other
        within the budget, the first of those with the least distance."""
        if self.empty:
            return
        for at, begin, end in self.regions(text):
            name, item, k = self.items[at]
            if at not in self.patterns:
                self.patterns[at] = (Pattern(item), Pattern(item[::-1]))
            forward, backward = self.patterns[at]
            best = None
            for place, d in enumerate(forward.distances(text[begin:end]), begin + 1):
                if d <= k:
                    if best is None or d < best[0]:
                        best = (d, place)
                elif best is not None:
                    yield self._placed(name, backward, text, begin, best, k)
                    best = None
            if best is not None:
                yield self._placed(name, backward, text, begin, best, k)

    @staticmethod
    def _placed(name, backward: Pattern, text: str, begin: int, best: tuple[int, int], k: int):
        d, end = best
        low = max(begin, end - backward.length - k)
        back = list(backward.distances(text[low:end][::-1]))
        return name, end - 1 - back.index(min(back)), end, d


_MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("distance", pa.int64())])
_MATCHES = "doc_id long, item_id long, start long, end long, distance long"


def _blocks(benchmark: DataFrame, chars: int):
    """Items (id, normal text) in blocks of about ``chars`` characters, empty ones left out.
    An item belongs to a block by its hash, so blocks need no numbering."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), or_empty("text").alias("text"))
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = int(total) // chars + 1
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        block = [(r.item_id, t) for r in rows if (t := normal(r.text))]
        if block:
            yield sorted(set(block), key=repr)


def matches(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, start, end, distance``: each place where an item stands in a text
    with at most ``percent`` of its characters edited. Places are code points of the text
    as given, the end exclusive.

    Null or blank texts match nothing, null or blank items are not looked for; rows that
    repeat an id give their own matches; equal items of one id count once. An empty table
    gives no rows. Other columns are ignored.
    """
    docs, spark = texts(documents), documents.sparkSession
    out = spark.createDataFrame([], _MATCHES)
    for block in _blocks(benchmark, block_chars):
        out = out.unionByName(_search(docs, spark.sparkContext.broadcast(block), percent))
    return out


def _search(docs: DataFrame, items, percent: int) -> DataFrame:
    def run(batches):
        matcher = Matcher(items.value, percent)
        for batch in parts(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = list(matcher.find(normal(text)))
                if found:
                    at = source_places(text)
                    rows += [(doc, name, at[a], at[b - 1] + 1, d) for name, a, b, d in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MATCH)], schema=_MATCH)

    return docs.mapInArrow(run, _MATCHES)
