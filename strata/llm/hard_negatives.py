"""Hard-negative mining with exact integer inner products, several at one multiplication.

Kronecker substitution. Components of a few candidates, shifted by a bias so that none is
negative, are packed into fields of one wide integer, for each dimension:
``P[j] = sum_f (c[f, j] + B) * 2^(w f)``. Then ``sum_j a[j] * P[j]`` costs one
multiplication per component of the anchor, and holds ``sum_j a[j] * (c[f, j] + B)`` in field
``f``. With ``M``, a bound on those sums, added to every field none is negative, so fields do
not borrow from each other; taking ``M + B * sum_j a[j]`` off again leaves exact scores.

* If two fields or more fit into 53 bits the wide integer is a double's significand, and
  the sums are a matrix product: every partial sum is an integer below 2^53, so exact in any
  order.
* Otherwise it is a Python integer with fields of 64 bits or a multiple, as wide as
  the largest component asks for.

Anchors (a stated hundredth of the rows) come in blocks of a fixed size; a block is
broadcast, all rows stream past it, and tasks keep the best few per anchor, so neither
memory nor the shuffle grows with the rows. A block takes two passes: positives, then
negatives in the window that each positive's score opens.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches
from strata.plans.sizing import materialize, scratch_path

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of a positive's score between which a negative is hard
SCALE = 256
ANCHOR_EVERY = 100
BLOCK = 1 << 20  # components of anchors broadcast at once, 8 MB
BATCH = 2_048  # rows multiplied at once
STRIP = 256  # anchors multiplied at once
EXACT_BITS = 53
EXACT = float(1 << EXACT_BITS)

_FAR = np.iinfo(np.int64)


def fields_of(bound: int) -> tuple[int, int]:
    """Bits of a field that holds 0 to ``2 * bound``, and how many fit a significand."""
    width = (2 * bound + 1).bit_length()
    return width, EXACT_BITS // width


def pack(values: np.ndarray, bias: int, width: int, fields: int) -> np.ndarray:
    """``P[group, j]``: rows of ``values`` (integers as doubles), ``fields`` to a group; the
    last group is filled up with rows of zero."""
    groups = -(-len(values) // fields)
    full = np.zeros((groups * fields, values.shape[1]))
    full[:len(values)] = values + bias
    shift = np.ldexp(1.0, width * np.arange(fields))
    return np.einsum("gfj,f->gj", full.reshape(groups, fields, -1), shift)


def unpack(sums: np.ndarray, bound: int, width: int, fields: int) -> np.ndarray:
    """``sums`` of shape (anchors, groups) to (anchors, groups * fields), each with ``bound``
    taken off again."""
    wide = sums.astype(np.int64) + bound * sum(1 << (width * f) for f in range(fields))
    mask = np.int64((1 << width) - 1)
    each = [((wide >> np.int64(width * f)) & mask) - bound for f in range(fields)]
    return np.stack(each, axis=2).reshape(len(sums), -1)


def _wide_scores(anchors: list[list[int]], rows: list[list[int]], bias: int, bound: int) -> list[list[int]]:
    """The same with Python integers, for components of any size."""
    width = -(-(2 * bound + 1).bit_length() // 64) * 64
    packed = [sum((c + bias) << (width * f) for f, c in enumerate(column)) for column in zip(*rows)]
    lift = sum(bound << (width * f) for f in range(len(rows)))
    out, size = [], width // 8
    for a in anchors:
        raw = (sum(x * p for x, p in zip(a, packed)) + lift).to_bytes(size * len(rows) + 8, "little")
        less = bound + bias * sum(a)
        out.append([int.from_bytes(raw[size * f:size * f + size], "little") - less for f in range(len(rows))])
    return out


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, (anchors, rows). Both hold integers as doubles. They come as ``int64``,
    or as Python integers where some might not fit."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    bias = int(max(0.0, -rows.min()))
    top = int(rows.max()) + bias
    if max(top, int(np.abs(anchors).max())) < 1 << 26:  # sums of such are exact themselves
        reach = int(np.abs(anchors).sum(axis=1).max())
        bound = max(1, reach * top)
        width, fields = fields_of(bound)
        # Lifted sums must stay below 2^53 too, as must their parts in any order.
        if fields >= 1 and reach * top * sum(1 << (width * f) for f in range(fields)) < EXACT:
            sums = anchors @ pack(rows, bias, width, fields).T
            found = unpack(sums, bound, width, fields)[:, :len(rows)]
            return found - (bias * anchors.sum(axis=1).astype(np.int64))[:, None]
    whole = [[int(x) for x in r] for r in rows]
    asked = [[int(x) for x in a] for a in anchors]
    bias = max(0, -min(map(min, whole)))
    bound = max(1, max(sum(map(abs, a)) for a in asked) * (max(map(max, whole)) + bias))
    wide = _wide_scores(asked, whole, bias, bound)
    out = np.empty((len(asked), len(whole)), object)
    for i, line in enumerate(wide):
        out[i] = line
    fits = all(_FAR.min // 100 < v < _FAR.max // 100 for line in wide for v in line)
    return out.astype(np.int64) if fits else out


def usable(embeddings: DataFrame, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part: no null among id, label,
    vector and components, and all components finite. Where the id is divisible by
    ``relabel_every`` the label becomes the next of ``labels``."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % relabel_every == 0, (label + 1) % labels).otherwise(label)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter("vec_id is not null and label is not null and embedding is not null").filter(finite)


class _Best:
    """The best ``k`` of each of many lists by score, then smaller id. A row that comes again
    with the same id and score counts once."""

    def __init__(self, lists: int, k: int):
        self.k, self.held = k, [([], []) for _ in range(lists)]
        self.floor = [None] * lists  # score from which a row can still get in

    def offer(self, at: int, found: np.ndarray, ids: np.ndarray) -> None:
        """``found`` and ``ids`` are a list's rows."""
        if self.floor[at] is not None:
            good = found >= self.floor[at]
            found, ids = found[good], ids[good]
        if not len(found):
            return
        if len(found) > 8 * self.k:
            # All as good as the k-th of distinct ids: equal rows must not push others out.
            order = np.lexsort((ids, -found)) if found.dtype != object else np.array(
                sorted(range(len(found)), key=lambda i: (-found[i], ids[i])))
            found, ids = found[order], ids[order]
            new = np.concatenate([[True], (found[1:] != found[:-1]) | (ids[1:] != ids[:-1])])
            found, ids = found[new][:self.k], ids[new][:self.k]
        one, two = self.held[at]
        both = sorted(set(zip((-v for v in [*one, *found.tolist()]), [*two, *ids.tolist()])))[:self.k]
        self.held[at] = [-v for v, _ in both], [i for _, i in both]
        if len(both) == self.k:
            self.floor[at] = -both[-1][0]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for at, (found, ids) in enumerate(self.held):
            for v, i in zip(found, ids):
                yield at, v, i


def _blocks(batches, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and quantised vectors, of one length of vectors at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False)
            labels = part.column("label").to_numpy(zero_copy_only=False)
            lists = part.column("embedding")
            lengths, values = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
            begins = np.cumsum(lengths) - lengths
            for n in np.unique(lengths).tolist():
                which = np.flatnonzero(lengths == n)
                taken = values[begins[which][:, None] + np.arange(n)] if n else np.zeros((len(which), 0))
                yield ids[which], labels[which], np.floor(taken * SCALE) + 0.0  # no negative zero


def _anchors(block: pa.Table) -> dict[int, tuple[np.ndarray, ...]]:
    """By length of vectors: places in the block, ids, labels, quantised vectors."""
    out: dict[int, list] = {}
    at = 0
    for batch in block.to_batches():
        for ids, labels, vectors in _blocks([batch], max(1, batch.num_rows)):
            out.setdefault(vectors.shape[1], []).append((ids, labels, vectors))
    found = {}
    for n, kept in sorted(out.items()):
        ids, labels, vectors = (np.concatenate(x) for x in zip(*kept))
        found[n] = (np.arange(at, at + len(ids)), ids, labels, vectors)
        at += len(ids)
    return found


def _key(label: int, vector: np.ndarray) -> int:
    """Tells anchors of one id apart by what they are."""
    return int.from_bytes(hashlib.blake2b(f"{label}:".encode() + vector.tobytes(), digest_size=8).digest(), "little", signed=True)


_I64 = pa.int64()
_TOP = pa.schema([("anchor_id", _I64), ("anchor_key", _I64), ("score", _I64), ("other_id", _I64)])
_TOP_DDL = "anchor_id long, anchor_key long, score long, other_id long"
_NEAR = pa.schema([*_TOP, ("positive_id", _I64), ("positive_score", _I64)])


def _rows(schema: pa.Schema, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Scores beyond 64 bits are refused here, by Arrow."""
    for at in range(0, len(rows), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + 50_000]), schema)], schema=schema)


def _compare(batches, anchors, held: _Best, offer, same: bool) -> None:
    """Score rows with all anchors of their length, strip by strip; only those of the same
    label where ``same``, else ``offer`` is told which rows have another."""
    for ids, labels, vectors in _blocks(batches, BATCH):
        if vectors.shape[1] not in anchors:
            continue
        places, anchor_ids, anchor_labels, asked = anchors[vectors.shape[1]]
        pairs = [(np.flatnonzero(anchor_labels == x), np.flatnonzero(labels == x)) for x in np.unique(labels)] if same else [
            (np.arange(len(places)), np.arange(len(ids)))]
        for left, right in pairs:
            shown, values = ids[right], vectors[right]
            for at in range(0, len(left), STRIP):
                strip = left[at:at + STRIP]
                for i, line in zip(strip.tolist(), scores(asked[strip], values)):
                    other = shown != anchor_ids[i] if same else labels != anchor_labels[i]
                    offer(held, int(places[i]), other, shown, line)


def _positives(rows: DataFrame, block, k: int) -> DataFrame:
    """Best ``k`` other rows of an anchor's label: ``anchor_id, anchor_key, score, other_id``."""
    def offer(held, place, other, ids, line):
        held.offer(place, line[other], ids[other])

    def run(batches):
        anchors = _anchors(block.value)
        named = {p: (i, _key(label, v)) for places, ids, labels, vectors in anchors.values()
                 for p, i, label, v in zip(places.tolist(), ids.tolist(), labels.tolist(), vectors)}
        held = _Best(len(named), k)
        _compare(batches, anchors, held, offer, same=True)
        yield from _rows(_TOP, [(*named[p], v, i) for p, v, i in held.rows()])

    return rows.mapInArrow(run, _TOP_DDL)


def _negatives(rows: DataFrame, block, positives, k: int, low: int, high: int) -> DataFrame:
    """Best ``k`` rows of another label in the window of each positive."""
    def run(batches):
        anchors = _anchors(block.value)
        of: dict[tuple[int, int], list] = {}
        found = positives.value
        for i, key, score, other in zip(*(found.column(c).to_pylist() for c in ("anchor_id", "anchor_key", "score", "other_id"))):
            of.setdefault((i, key), []).append((score, other))
        windows: dict[int, list[tuple[int, int, int]]] = {}
        lists: list[tuple] = []
        for places, ids, labels, vectors in anchors.values():
            for p, i, label, v in zip(places.tolist(), ids.tolist(), labels.tolist(), vectors):
                key = _key(label, v)
                for score, other in of.get((i, key), ()):
                    # Scores s with low * score <= 100 s <= high * score.
                    windows.setdefault(p, []).append((len(lists), -(-low * score // 100), high * score // 100))
                    lists.append((i, key, other, score))
        held = _Best(len(lists), k)

        def offer(held, place, other, ids, line):
            wanted = windows.get(place)
            if not wanted:
                return
            least = min(max(a, a if held.floor[n] is None else held.floor[n]) for n, a, _ in wanted)
            most = max(b for _, _, b in wanted)
            good = other & (line >= least) & (line <= most)
            if not good.any():
                return
            line, ids = line[good], ids[good]
            for n, a, b in wanted:
                inside = (line >= a) & (line <= b)
                held.offer(n, line[inside], ids[inside])

        _compare(batches, anchors, held, offer, same=False)
        yield from _rows(_NEAR, [(*lists[n][:2], v, i, *lists[n][2:]) for n, v, i in held.rows()])

    return rows.mapInArrow(run, f"{_TOP_DDL}, positive_id long, positive_score long")


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    """First ``k`` by score, then smaller id, of what tasks kept: at most ``k`` a task and
    list, of which the window group limit keeps ``k`` before the shuffle. Equal rows share a
    rank and become one, on the same partitions."""
    keys = ", ".join(by)
    ranked = found.selectExpr("*", f"dense_rank() over (partition by {keys} order by score desc, other_id) as rank")
    return ranked.filter(F.col("rank") <= k).dropDuplicates([*by, "rank"])


def mine(
    embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    anchor_every: int = ANCHOR_EVERY, block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` (see
    ``op13``) of ``vec_id, label, embedding``.

    Rows without an id, label or vector, or with a null or non-finite component, take no
    part. Vectors are compared with vectors of their length only; empty ones score 0. Ids may
    repeat: a row with the anchor's id is none of its others, rows of one id are anchors each,
    equal ones are one, and rows of one id with the same score count once. An anchor without
    positives, or a positive without negatives in its window, gives no rows; an empty table
    gives none. Other columns are ignored. A score beyond 64 bits raises an error.
    """
    spark = embeddings.sparkSession
    rows = materialize(usable(embeddings))
    asked = materialize(rows.filter(F.col("vec_id") % anchor_every == 0).distinct())
    blocks = -(-(asked.agg(F.sum(F.size("embedding") + 4)).first()[0] or 0) // block)
    place = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(max(1, blocks)))
    out = scratch_path(spark, "negatives")
    with small_batches(spark, BATCH):
        for number in range(max(1, blocks)):
            anchors = spark.sparkContext.broadcast(asked.filter(place == number).toArrow())
            best = materialize(_first(_positives(rows, anchors, positives), positives, "anchor_id", "anchor_key"))
            # At most ``positives`` rows for each anchor of the block.
            near = spark.sparkContext.broadcast(best.select("anchor_id", "anchor_key", "score", "other_id").toArrow())
            found = _negatives(rows, anchors, near, negatives, low, high)
            kept = _first(found, negatives, "anchor_id", "anchor_key", "positive_id", "positive_score")
            kept.select(
                "anchor_id", F.col("other_id").alias("negative_id"), "positive_id", "rank", "positive_score", F.col("score").alias("negative_score"),
            ).write.mode("append").parquet(out)
            anchors.unpersist()
            near.unpersist()
    return spark.read.schema(
        "anchor_id long, negative_id long, positive_id long, rank int, positive_score long, negative_score long",
    ).parquet(out).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
