"""Substring dedup: words covered by a long window that also starts somewhere else.

Prefix-partitioned suffix trees. A window of ``window`` words is a suffix, of which only
the first ``window`` words matter: it repeats if it hangs below an internal node of the
suffix tree at that depth. The tree is never built as a whole:

* A window is filed under the smallest (by hash) of its ``PREFIX``-word sequences. Equal
  windows have the same one at the same place, so they fall into one group; windows in a
  row mostly share it and travel together, as one run of words.
* First all such prefixes are counted. Runs whose prefix occurs once cannot repeat; they
  are left out by a bitmap of fixed size (a false hit costs time, never a result).
* Prefixes that are too frequent for one group are lengthened to the whole window, whose
  node needs no subtree: there, only whether two suffixes reach it matters.
* A group's subtree is built level by level: suffixes with the same words so far are a
  node, a node with one suffix is a leaf and dropped. What is left at full depth repeats.

Tasks fold equal runs before anything is shuffled: all but the first of them are known to
repeat on the spot, so a passage of a third of all documents sends a row for each task.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import parts, texts
from strata.llm.words import groups, mix, ngrams, word_hashes
from strata.plans.sizing import materialize

PREFIX = 12  # words
BITMAP_BITS = 27  # 16 MB, whatever the size of the corpus
FREQUENT = 5_000  # occurrences from which a prefix is lengthened
MOST_FREQUENT = 1 << 16  # a fixed bound on how many are
CHUNK = 2_000_000  # prefixes counted at once within a task
FOLD = 100_000  # runs a task remembers
LEVELS = (4, 12)  # words added to a node's depth at each level; the rest comes last
CELL = 5  # bytes of a word's hash within a run

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_I64, _I32 = pa.int64(), pa.int32()


def _runs(h: np.ndarray, bounds: np.ndarray, window: int):
    """Runs of windows that share their smallest prefix: text, first window, last window,
    place of the prefix (all as places in ``h``), hash of the prefix."""
    short = min(PREFIX, window)
    grams = ngrams(h, short)
    wide = window - short + 1
    if len(grams) < wide:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    lengths = np.maximum(np.diff(bounds) - window + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    first = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    if not len(first):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    anchor = first + sliding_window_view(grams, wide)[first].argmin(axis=1) if len(first) < 50_000 else np.concatenate(
        [part + sliding_window_view(grams, wide)[part].argmin(axis=1) for part in np.array_split(first, len(first) // 50_000 + 1)])
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(first)]]) - 1
    return owner[at], first[at], first[last], anchor[at], grams[anchor[at]]


def _batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_COUNTS = pa.schema([("prefix", _I64), ("n", _I64)])


def prefix_counts(docs: DataFrame, window: int) -> DataFrame:
    """How often each prefix is the smallest of a run, over all texts: ``prefix, n``."""
    def counted(held):
        p, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(p), 500_000):
            yield _batch(_COUNTS, [p[at:at + 500_000].view(np.int64), n[at:at + 500_000]])

    def run(batches):
        held, total = [], 0
        for batch in parts(batches):
            for _, part in groups(batch.column("text").to_pylist()):
                h, _, _, bounds = word_hashes(part)
                held.append(_runs(h, bounds, window)[4])
                total += len(held[-1])
                if total >= CHUNK:
                    yield from counted(held)
                    held, total = [], 0
        if total:
            yield from counted(held)

    return docs.select("text").mapInArrow(run, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n")).filter("n > 1")


def _bitmap(counts: DataFrame, bits: int) -> np.ndarray:
    """Bit ``prefix mod 2^bits`` is set for every prefix that occurs twice. Put together
    from 64-bit cells, so what reaches the driver is bounded by the bitmap's own size."""
    slot = F.col("prefix").bitwiseAND(F.lit((1 << bits) - 1))
    cells = counts.select(F.shiftright(slot, 6).alias("cell"), F.expr("shiftleft(1L, cast(prefix & 63 as int))").alias("bit")).groupBy(
        "cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return out


# ``words``: a run's words, with ``anchor`` the place of the prefix in it. Without words:
# ``anchor`` 0 is a span known to repeat, 1 a single window whose key is its own hash.
_RUN = pa.schema([("key", _I64), ("doc", _I64), ("text_hash", _I64), ("start", _I64), ("end", _I64), ("anchor", _I32), ("words", pa.binary())])
_RUNS = "key long, doc long, text_hash long, start long, end long, anchor int, words binary"


def _content(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``h[a:b]`` for many a, b: sums of words mixed with their places."""
    out = np.empty(len(a), np.uint64)
    for part in np.array_split(np.arange(len(a)), max(1, int((b - a).sum()) // 1_000_000)):
        n = (b - a)[part]
        begins = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(begins, n)
        with np.errstate(over="ignore"):
            each = mix(h[np.repeat(a[part], n) + place] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            out[part] = mix(np.add.reduceat(each, begins) + n.astype(np.uint64)) if len(part) else 0
    return out


def runs(docs: DataFrame, window: int, bitmap, frequent) -> DataFrame:
    """Runs whose prefix may occur twice, folded within a task."""
    def run(batches):
        bits, many = bitmap.value, frequent.value
        mask = np.uint64(len(bits) * 64 - 1)
        seen: dict[int, tuple | None] = {}
        for batch in parts(batches):
            docs_, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            rows: list[tuple] = []

            def known(doc, hash_, start, end):
                key = (start * 0x9E3779B97F4A7C15 ^ hash_) & (2**63 - 1)  # spreads evenly; means nothing
                rows.append((key, doc, hash_, start, end, 0, None))

            for at, part in groups(batch.column("text").to_pylist()):
                h, _, _, bounds = word_hashes(part)
                owner, first, last, anchor, prefix = _runs(h, bounds, window)
                slot = prefix & mask
                hit = (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
                owner, first, last, anchor, prefix = owner[hit], first[hit], last[hit], anchor[hit], prefix[hit]
                heavy = np.isin(prefix, many)
                if heavy.any():
                    # Each window of these on its own, under the hash of all its words.
                    n = (last - first + 1)[heavy]
                    w = np.repeat(first[heavy] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    owner = np.concatenate([owner[~heavy], np.repeat(owner[heavy], n)])
                    single = np.concatenate([np.zeros(int((~heavy).sum()), bool), np.ones(len(w), bool)])
                    first, last = np.concatenate([first[~heavy], w]), np.concatenate([last[~heavy], w])
                    anchor = np.concatenate([anchor[~heavy], w])
                    prefix = np.concatenate([prefix[~heavy], ngrams(h, window)[w]])
                else:
                    single = np.zeros(len(first), bool)
                if not len(first):
                    continue
                names = _content(h, first, last + window).tolist()
                cells = h.view(np.uint8).reshape(-1, 8)[:, :CELL].tobytes()
                base = bounds[owner]
                for o, f, end, a, p, s, name, b in zip(owner.tolist(), first.tolist(), (last + window).tolist(), anchor.tolist(),
                                                       prefix.view(np.int64).tolist(), single.tolist(), names, base.tolist()):
                    doc, hash_ = docs_[at + o], hashes[at + o]
                    if name in seen:
                        before = seen[name]
                        if before is not None:
                            known(*before)
                            seen[name] = None
                        known(doc, hash_, f - b, end - b)
                        continue
                    if len(seen) >= FOLD:
                        seen.clear()
                    seen[name] = (doc, hash_, f - b, end - b)
                    rows.append((p, doc, hash_, f - b, end - b, 1 if s else a - f, None if s else cells[f * CELL:end * CELL]))
                if len(rows) > 20_000:
                    yield _batch(_RUN, zip(*rows))
                    rows = []
            if rows:
                yield _batch(_RUN, zip(*rows))

    return docs.mapInArrow(run, _RUNS)


_SPAN = pa.schema([("doc", _I64), ("text_hash", _I64), ("start", _I64), ("end", _I64)])


def subtree_repeats(key: np.ndarray, anchor: np.ndarray, words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of runs (grouped by ``key``): run number and offset of every window that is below an
    internal node at full depth."""
    lengths = np.array([len(w) // CELL for w in words])
    raw = np.frombuffer(b"".join(words), np.uint8).reshape(-1, CELL)
    flat = np.zeros((len(raw), 8), np.uint8)
    flat[:, :CELL] = raw
    flat = flat.view(np.uint64).ravel()
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    n = lengths - window + 1
    run = np.repeat(np.arange(len(words)), n)
    offset = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    with np.errstate(over="ignore"):
        node = mix(key[run].view(np.uint64) + (anchor[run] - offset).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    depth = 0
    steps = [s for s in LEVELS if s < window]
    while steps and sum(steps) >= window:
        steps.pop()
    for step in (0, *steps, window - sum(steps)):
        if step:
            block = ngrams(flat, step)
            with np.errstate(over="ignore"):
                node = mix(node * np.uint64(0xD6E8FEB86659FD93) + block[starts[run] + offset + depth])
        _, of, size = np.unique(node, return_inverse=True, return_counts=True)
        inner = size[of] > 1
        run, offset, node = run[inner], offset[inner], node[inner]
        depth += step
        if not len(run):
            break
    return run, offset


def _solve(table: pa.Table, window: int):
    """Spans that repeat, out of whole groups of rows."""
    kind = table["anchor"].to_numpy()
    bare = table["words"].is_null().to_numpy()
    known = bare & (kind == 0)
    if known.any():
        yield from table.filter(pa.array(known)).select(_SPAN.names).to_batches()
    single = bare & (kind == 1)
    if single.any():
        t = table.filter(pa.array(single))
        _, of, size = np.unique(t["key"].to_numpy(), return_inverse=True, return_counts=True)
        yield from t.filter(pa.array(size[of] > 1)).select(_SPAN.names).to_batches()
    if not bare.all():
        t = table.filter(pa.array(~bare))
        key = t["key"].to_numpy()
        _, of, size = np.unique(key, return_inverse=True, return_counts=True)
        t = t.filter(pa.array(size[of] > 1))
        if not t.num_rows:
            return
        run, offset = subtree_repeats(t["key"].to_numpy(), t["anchor"].to_numpy().astype(np.int64), t["words"].to_pylist(), window)
        if not len(run):
            return
        order = np.lexsort([offset, run])
        run, offset = run[order], offset[order]
        new = np.concatenate([[True], (run[1:] != run[:-1]) | (offset[1:] != offset[:-1] + 1)])
        a = np.flatnonzero(new)
        b = np.concatenate([a[1:], [len(run)]]) - 1
        begin = t["start"].to_numpy()[run[a]]
        picked = t.take(pa.array(run[a]))
        yield _batch(_SPAN, [picked["doc"].combine_chunks(), picked["text_hash"].combine_chunks(), begin + offset[a], begin + offset[b] + window])


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """``doc, text_hash, start, end`` (words) of what repeats; spans may overlap."""
    spark = docs.sparkSession
    counts = materialize(prefix_counts(docs, window))
    often = counts.filter(F.col("n") > FREQUENT).orderBy(F.desc("n"), "prefix").limit(MOST_FREQUENT).select("prefix").toArrow()
    bitmap = spark.sparkContext.broadcast(_bitmap(counts, BITMAP_BITS))
    frequent = spark.sparkContext.broadcast(np.sort(often["prefix"].to_numpy().view(np.uint64)))

    def run(batches):
        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if carry is not None:
                table = pa.concat_tables([carry, table])
            key = table["key"].to_numpy()
            ready = int(np.searchsorted(key, key[-1]))  # the last group may go on
            if ready:
                yield from _solve(table.slice(0, ready), window)
            carry = table.slice(ready)
        if carry is not None:
            yield from _solve(carry, window)

    filed = runs(docs, window, bitmap, frequent).repartition("key").sortWithinPartitions("key")
    return filed.mapInArrow(run, "doc long, text_hash long, start long, end long")


_RESULT = pa.schema([("doc_id", _I64), ("n_words", _I64), ("n_removed", _I64), ("kept_sha256", pa.string()), ("kept", pa.string())])


def remove_repeats(documents: DataFrame, window: int = 35, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and ``kept`` (words joined by a blank) for
    every row (see ``op7``); windows are judged on the input.

    Null text has no words. Texts shorter than the window stay whole. Rows that repeat an id
    are judged by their own text; a repeated row is a copy, so its windows are removed. An
    empty table gives no rows. Other columns are ignored.
    """
    docs = texts(documents).withColumn("text_hash", F.xxhash64("text"))
    spans = repeated_spans(docs.select("doc_id", "text_hash", "text"), window)
    per_doc = spans.groupBy(F.coalesce("doc", F.lit(-1)).alias("_doc"), F.col("text_hash").alias("_hash")).agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))  # copies under one id have the same
    keyed = docs.withColumn("_doc", F.coalesce("doc_id", F.lit(-1)))
    joined = keyed.join(per_doc, (keyed["_doc"] == per_doc["_doc"]) & (keyed["text_hash"] == per_doc["_hash"]), "left")
    out = pa.schema([f for f in _RESULT if with_text or f.name != "kept"])

    def run(batches):
        for batch in parts(batches):
            rows, size = [], 0
            spans_ = batch.column("spans")
            for i, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())):
                words = _WORD.findall(text.encode())
                n = len(words)
                found = spans_[i].as_py()
                if found:
                    gone = np.zeros(n + 1, np.int64)
                    np.add.at(gone, [s["start"] for s in found], 1)
                    np.add.at(gone, [s["end"] for s in found], -1)
                    stay = np.cumsum(gone[:n]) == 0
                    words = [w for w, s in zip(words, stay.tolist()) if s]
                kept = b" ".join(words)
                rows.append((doc, n, n - len(words), hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
                size += len(kept)
                if size > 8 << 20:
                    yield _batch(out, zip(*rows))
                    rows, size = [], 0
            if rows:
                yield _batch(out, zip(*rows))

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)
