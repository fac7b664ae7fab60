"""N-gram Jaccard join: exact components of documents with alike shingle sets.

Size-aware heavy-light join on the prefix principle. Shingles have one global order, rare
ones first; two sets with enough in common share a shingle among their first few.

* Small sets enumerate the subsets of two shingles of their prefix (one longer) as keys: a
  pair must agree on two at once, so few strangers meet. Large sets would have too many
  subsets; for them, each shingle of the prefix is a key, an inverted list that is scanned.
  The boundary is the size at which the sum of both costs is least. Large sets near enough
  to the boundary to have small partners enumerate subsets as well.
* Equal sets are one set from the beginning; their documents are never paired.
* Sets with the same most crowded key are compared in a block: by bitmaps first, which
  leave few strangers, then by counting along the inverted lists of all shingles of the rest,
  which finds most components at once. What later meets in other lists is compared only where
  it is not yet in one component: first all with one member of a list, then what is still
  apart, one part of a list against another.

The order and the boundary decide cost only; whatever they are, no link is lost. Sets are
of 64-bit hashes, of which all bits are compared; links are decided by integer arithmetic
on their sizes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import parts, small_batches, texts
from strata.llm.words import groups, mix, shingle_sets
from strata.plans.sizing import broadcast_if_small, materialize

FREQUENT = 1 << 18  # shingles whose frequency the order knows; a fixed bound
COUNT_CHUNK = 1_000_000  # shingles counted at once within a task
BLOCK = 1_500  # sets compared with each other in memory
LIST_PART = 500  # postings of one list that meet others at once
SEEN = 1_000_000  # set ids a task remembers
SAMPLE = np.uint64(1023)  # one shingle in 1,024 (by hash) tells how long lists are
STARS = 1
_I64 = pa.int64()


def _set_id(s: np.ndarray) -> int:
    """64-bit id of a set, from a sum that does not depend on order, and its size."""
    with np.errstate(over="ignore"):
        total = np.sum(mix(s ^ np.uint64(0xA5A5A5A5DEADBEEF)), dtype=np.uint64) + np.uint64(len(s))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _sets(batch: pa.RecordBatch, k: int):
    """``(doc_id, set)`` for the rows of a batch, a bounded number of bytes at a time."""
    ids = batch.column("doc_id").to_pylist()
    for at, part in groups(batch.column("text").to_pylist()):
        yield from zip(ids[at:], shingle_sets(part, k))


_PROFILE = pa.schema([("doc_id", _I64), ("n", _I64), ("set_id", _I64), ("token", _I64), ("seen", _I64), ("sampled", pa.bool_())])


def profile(docs: DataFrame, k: int) -> DataFrame:
    """First pass. A row for each document (``doc_id, n, set_id``), and rows that report
    frequent shingles of a task (``token, seen``) or a hash sample of all (``sampled``).
    A set counts once within a task, however many copies there are."""
    def counted(held: list[np.ndarray]):
        tokens, n = np.unique(np.concatenate(held), return_counts=True)
        often, some = n >= 3, (tokens & SAMPLE) == 0
        pick = often | some
        t, c, o, s = tokens[pick].view(np.int64), n[pick], often[pick], some[pick]
        for mask, flag in ((o, False), (s, True)):
            m = int(mask.sum())
            if m:
                yield _batch(_PROFILE, [[None] * m, [None] * m, [None] * m, t[mask], c[mask], [flag] * m])

    def run(batches):
        held, total, seen = [], 0, set()
        for batch in parts(batches):
            rows = []
            for doc, s in _sets(batch, k):
                name = _set_id(s)
                rows.append((doc, len(s), name))
                if len(s) and name not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(name)
                    held.append(s)
                    total += len(s)
                    if total >= COUNT_CHUNK:
                        yield from counted(held)
                        held, total = [], 0
            if rows:
                nothing = [None] * len(rows)
                yield _batch(_PROFILE, [*zip(*rows), nothing, nothing, nothing])
        if held:
            yield from counted(held)

    return docs.mapInArrow(run, "doc_id long, n long, set_id long, token long, seen long, sampled boolean")


def least_overlap(n: int, percent: int) -> int:
    """Fewest shared shingles a set of size ``n`` needs with any partner."""
    return -(-n * percent // 100)


def boundary(sizes: dict[int, int], list_length: float, percent: int) -> int:
    """Largest size to enumerate subsets for: the split of sizes with the least cost."""
    best, best_cost, at = 0, None, 0
    top = max(sizes, default=0)
    small = {n: math.comb(n - least_overlap(n, percent) + 2, 2) for n in sizes}
    large = {n: (n - least_overlap(n, percent) + 1) * (1 + list_length) for n in sizes}
    total = sum(large[n] * c for n, c in sizes.items())
    for n in sorted({0, *sizes}):
        if n:
            at += (small[n] - large[n]) * sizes[n]
        cost = total + at
        if best_cost is None or cost < best_cost:
            best, best_cost = n, cost
    return min(best, top)


_POSTING = pa.schema([("key", _I64), ("set_id", _I64), ("n", pa.int32()), ("at", pa.int32())])
_POSTINGS = "key long, set_id long, n int, at int"


def _pair_keys(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.triu_indices(len(order), 1)
    with np.errstate(over="ignore"):
        keys = mix(order[i] * np.uint64(0xD6E8FEB86659FD93) + mix(order[j] ^ np.uint64(0x5851F42D4C957F2D)))
    return keys, i


def postings(docs: DataFrame, k: int, percent: int, limit: int, frequent) -> DataFrame:
    """Second pass: the keys of every set. ``at`` is where in its order the key begins."""
    def run(batches):
        tokens, rank = frequent.value
        seen: set[int] = set()
        for batch in parts(batches):
            out: list[tuple] = []
            for _, s in _sets(batch, k):
                n = len(s)
                keep = least_overlap(n, percent)
                if not n or (keep == n and (n + 1) * percent > 100 * n):
                    continue  # only an equal set can be its partner
                name = _set_id(s)
                if name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                where = np.minimum(np.searchsorted(tokens, s), max(len(tokens) - 1, 0))
                known = tokens[where] == s if len(tokens) else np.zeros(n, bool)
                often = s[known]
                order = np.concatenate([s[~known], often[np.argsort(rank[where[known]], kind="stable")]]) if len(often) else s
                if n > limit:
                    p = order[:n - keep + 1]
                    out.append((p, np.full(len(p), name), n, np.arange(len(p))))
                if n * percent <= 100 * limit:
                    keys, at = _pair_keys(order[:n - keep + 2])
                    out.append((keys, np.full(len(keys), name), n, at))
            if out:
                sizes = [len(o[0]) for o in out]
                yield _batch(_POSTING, [np.concatenate([o[0] for o in out]).view(np.int64), np.concatenate([o[1] for o in out]),
                                        np.repeat([o[2] for o in out], sizes).astype(np.int32),
                                        np.concatenate([o[3] for o in out]).astype(np.int32)])

    return docs.mapInArrow(run, _POSTINGS)


def shared_keys(all_postings: DataFrame, percent: int) -> DataFrame:
    """Postings that some other set meets under the same key, and may be alike to, by their
    sizes and places. Rows stream past in order of key; lists of up to ``SHORT`` postings
    are looked at pair by pair, of longer ones all are kept."""
    def run(batches):
        carry, long_key = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if carry is not None:
                table = pa.concat_tables([carry, table])
            key = table["key"].to_numpy()
            ready = int(np.searchsorted(key, key[-1]))  # the last list may go on
            if len(key) - ready > LONGEST_CARRY:
                ready, long_next = len(key), key[-1]
            else:
                long_next = long_key
            if ready:
                yield from _meeting(table.slice(0, ready), percent, long_key)
            carry, long_key = table.slice(ready), long_next
        if carry is not None and carry.num_rows:
            yield from _meeting(carry, percent, long_key)

    ordered = all_postings.repartition("key").sortWithinPartitions("key", "n", "set_id", "at")
    return ordered.mapInArrow(run, _POSTINGS)


SHORT = 8
LONGEST_CARRY = 50_000


def _meeting(table: pa.Table, percent: int, long_key: int | None):
    key, name = table["key"].to_numpy(), table["set_id"].to_numpy()
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])
    table = table.filter(pa.array(fresh))
    key = key[fresh]
    n, at = table["n"].to_numpy().astype(np.int64), table["at"].to_numpy().astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([new, [len(key)]]))
    keep = np.repeat(size > SHORT, size)
    if long_key is not None:
        keep |= key == long_key
    for d in range(1, min(SHORT, len(key))):
        meet = (key[d:] == key[:-d]) & ((100 + percent) * np.minimum(n[d:] - at[d:], n[:-d] - at[:-d]) >= percent * (n[d:] + n[:-d]))
        keep[d:] |= meet
        keep[:-d] |= meet
    return table.filter(pa.array(keep)).to_batches()


def bitmap(s: np.ndarray) -> np.ndarray:
    """Bytes of a bitmap with a bit for every shingle; some three bits or more for each."""
    size = 1 << max(6, int(3 * len(s)).bit_length())
    out = np.zeros(size, bool)
    out[(s >> np.uint64(20)) & np.uint64(size - 1)] = True
    return np.packbits(out, bitorder="little")


def most_shared(a: np.ndarray, n: int, b: np.ndarray, m: int) -> int:
    """No two sets of sizes n, m with these bitmaps share more: a bit that only one has
    stands for at least one shingle that only it has. The longer bitmap is folded."""
    if len(a) > len(b):
        a, n, b, m = b, m, a, n
    b = np.bitwise_or.reduce(b.reshape(-1, len(a)), axis=0)
    return min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))


def of_sets(docs: DataFrame, wanted: DataFrame, k: int, name: str, form) -> DataFrame:
    """``wanted`` (``set_id`` with a document for each, ``doc_id``, and whatever else), with
    ``n`` and the bytes that ``form`` makes of the set. A set comes twice only if rows of one
    id have the same text; all that reads the result allows for it."""
    others = [c for c in wanted.columns if c != "doc_id"]
    schema = T.StructType([*wanted.select(*others).schema, T.StructField("n", T.LongType()), T.StructField(name, T.BinaryType())])

    def run(batches):
        for batch in parts(batches):
            names = batch.column("set_id").to_pylist()
            rows, sizes, made = [], [], []
            for at, part in groups(batch.column("text").to_pylist()):
                for i, s in enumerate(shingle_sets(part, k), at):
                    if _set_id(s) == names[i]:
                        rows.append(i)
                        sizes.append(len(s))
                        made.append(form(s))
            if rows:
                kept = batch.select(others).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sizes, _I64), pa.array(made, pa.binary())], names=[*others, "n", name])

    rows = docs.join(broadcast_if_small(wanted), "doc_id")
    return rows.select("text", *others).mapInArrow(run, schema)


def bitmaps(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    return of_sets(docs, wanted, k, "bits", lambda s: bitmap(s).tobytes())


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """All 64 bits of every shingle: what decides."""
    return of_sets(docs, wanted, k, "tokens", lambda s: s.tobytes())


def may_link(sizes: list[int], bits: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each set may be alike to another one, by sizes and bitmaps. Those found to
    have a partner are not compared any further, so a group of copies takes one round."""
    order = np.argsort(np.array(sizes), kind="stable")
    n = np.array(sizes, np.int64)[order]
    width = np.array([len(bits[i]) for i in order])
    folded: dict[tuple[int, int], np.ndarray] = {}

    def at_width(of: int, to: int) -> np.ndarray:
        if (of, to) not in folded:
            rows = np.stack([bits[i] for i in order[width == of]])
            folded[of, to] = np.bitwise_or.reduce(rows.reshape(len(rows), -1, to), axis=1)
        return folded[of, to]

    # Widths never fall with sizes, so sets of one width are neighbours.
    begin = {w: int(np.searchsorted(width, w)) for w in np.unique(width).tolist()}
    end = {w: int(np.searchsorted(width, w, side="right")) for w in begin}
    found = np.zeros(len(n), bool)
    for i in range(len(n)):
        if found[i]:
            continue
        low, high = np.searchsorted(n * 100, n[i] * percent), np.searchsorted(n * percent, n[i] * 100, side="right")
        own = int(width[i])
        for w in begin:
            a, b = max(int(low), begin[w]), min(int(high), end[w])
            if a >= b:
                continue
            to = min(w, own)
            mine, theirs = at_width(own, to)[i - begin[own]], at_width(w, to)[a - begin[w]:b - begin[w]]
            shared = np.minimum(n[i] - np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64),
                                n[a:b] - np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64))
            hit = (100 + percent) * shared >= percent * (n[i] + n[a:b])
            if a <= i < b:
                hit[i - a] = False
            if hit.any():
                found[a:b] |= hit
                found[i] = True
    out = np.zeros(len(n), bool)
    out[order] = found
    return out


def block_components(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Label of each set: the place of the first of its component. Overlaps of one set with
    all others are counted along the inverted lists of its shingles."""
    sizes = np.array([len(s) for s in sets])
    label = np.arange(len(sets))
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    begins = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    lengths = np.diff(np.concatenate([begins, [len(flat)]]))
    heads = flat[begins]
    many = lengths > 1
    heads, begins, lengths = heads[many], begins[many], lengths[many]
    if not len(heads):
        return label
    for i, s in enumerate(sets):
        at = np.minimum(np.searchsorted(heads, s), len(heads) - 1)
        at = at[heads[at] == s]
        runs = lengths[at]
        if not len(runs):
            continue
        # Places of all rows of these lists, without a loop over lists.
        places = np.repeat(begins[at] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
        overlap = np.bincount(owner[places], minlength=len(sets))
        linked = np.flatnonzero((100 + percent) * overlap >= percent * (sizes[i] + sizes))
        if len(linked) > 1:
            labels = np.unique(label[linked])
            if len(labels) > 1:
                label[np.isin(label, labels)] = labels[0]
    return label


_NAMES = pa.schema([("set_id", _I64)])
_LABEL = pa.schema([("set_id", _I64), ("comp", _I64)])


def _by_block(frame: DataFrame, column: str, schema: pa.Schema, solve, returns: str) -> DataFrame:
    """``solve`` on the names and bytes of each block's sets; blocks stream through a task
    one after the other."""
    def run(batches):
        held, current = [], None
        for batch in parts(batches):
            out = []
            c = batch.to_pydict()
            for row in zip(c["set_id"], c["n"], c[column], c["home"], c["block"]):
                if row[3:] != current:
                    if len(held) > 1:
                        out += solve(held)
                    held, current = [], row[3:]
                elif row[0] == held[-1][0]:
                    continue  # the same set again
                held.append(row)
            if out:
                yield _batch(schema, zip(*out))
        if len(held) > 1 and (out := solve(held)):
            yield _batch(schema, zip(*out))

    placed = frame.filter("home is not null").repartition("home", "block").sortWithinPartitions("home", "block", "set_id")
    return placed.select("set_id", "n", column, "home", "block").mapInArrow(run, returns)


def home_components(docs: DataFrame, stored: DataFrame, of_set: DataFrame, k: int, percent: int) -> DataFrame:
    """``set_id, comp, home, block`` for every stored set. Bitmaps first tell which sets of
    a block may be alike to another one there; only these send their shingles."""
    def candidates(rows):
        maybe = may_link([r[1] for r in rows], [np.frombuffer(r[2], np.uint8) for r in rows], percent)
        return [(r[0],) for r, m in zip(rows, maybe.tolist()) if m]

    def solve(rows):
        label = block_components([np.frombuffer(r[2], np.uint64) for r in rows], percent).tolist()
        smallest: dict[int, int] = {}
        for x, row in zip(label, rows):
            smallest[x] = min(row[0], smallest.get(x, row[0]))
        return [(row[0], smallest[x]) for x, row in zip(label, rows)]

    sets = stored.select("set_id", "home", "block").distinct()
    near = materialize(_by_block(stored, "bits", _NAMES, candidates, "set_id long"))
    wanted = sets.join(broadcast_if_small(near.join(of_set, "set_id")), "set_id")
    solved = _by_block(whole_sets(docs, wanted, k), "tokens", _LABEL, solve, "set_id long, comp long")
    return sets.join(broadcast_if_small(solved), "set_id", "left").select("set_id", F.coalesce("comp", "set_id").alias("comp"), "home", "block")


def _with_both(pairs: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """Pairs ``a, b`` with ``n`` and a column of both sets. Where the pairs are few, they go
    to the sets, and only sets that are in a pair move."""
    pairs = broadcast_if_small(pairs)
    left = pairs.join(stored.select(F.col("set_id").alias("a"), F.col("n").alias("_n"), F.col(column).alias("_a")), "a")
    right = pairs.join(stored.select(F.col("set_id").alias("b"), F.col("n").alias("_m"), F.col(column).alias("_b")), "b")
    return left.join(right, ["a", "b"]).select("a", "b", "_n", "_m", "_a", "_b")


def linked_pairs(docs: DataFrame, pairs: DataFrame, stored: DataFrame, of_set: DataFrame, k: int, percent: int) -> DataFrame:
    """``a, b`` of those pairs of sets that are alike enough. Bitmaps, a fifteenth of the
    sets' size, first rule out most that cannot be; the sets themselves decide, which are
    made for what is left."""
    def chosen(batches, test):
        for batch in parts(batches, 500):
            c = batch.select(["_n", "_m"]).to_pydict()
            keep = [test(n, m, x.as_buffer(), y.as_buffer()) for n, m, x, y in zip(c["_n"], c["_m"], batch.column("_a"), batch.column("_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def possible(n, m, x, y):
        return (100 + percent) * most_shared(np.frombuffer(x, np.uint8), n, np.frombuffer(y, np.uint8), m) >= percent * (n + m)

    def alike(n, m, x, y):
        both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
        both.sort(kind="stable")
        return (100 + percent) * int(np.count_nonzero(both[1:] == both[:-1])) >= percent * (n + m)

    left = materialize(_with_both(pairs, stored, "bits").mapInArrow(lambda batches: chosen(batches, possible), "a long, b long").distinct())
    ends = left.select(F.col("a").alias("set_id")).unionByName(left.select(F.col("b").alias("set_id"))).distinct()
    sets = materialize(whole_sets(docs, ends.join(of_set, "set_id"), k))
    return _with_both(left, sets, "tokens").mapInArrow(lambda batches: chosen(batches, alike), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of an undirected graph ``a, b``: root is the smallest node that can be
    reached. Alternating large-star and small-star steps; each sends a row per edge, keeps
    only minima per node, and is stored, until all components are stars."""
    def large(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()

    def small(e):
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        hung = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hung.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_stars(now):
        now = materialize(small(large(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller node to hang on, which hangs on none: then that
    is the smallest of its component."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Component labels after linking the components of ``a, b`` (set ids)."""
    by = comps.select("set_id", "comp")
    edges = links.join(by.select(F.col("set_id").alias("a"), F.col("comp").alias("x")), "a").join(
        by.select(F.col("set_id").alias("b"), F.col("comp").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = broadcast_if_small(components(edges))
    joined = comps.join(roots, comps["comp"] == roots["node"], "left")
    return materialize(joined.select("set_id", F.coalesce("root", "comp").alias("comp"), "home", "block"))


def _enough(percent: int):
    """Whether a pair that first meets at ``at`` and ``at2`` can still share enough."""
    n, m, i, j = (F.col(c).cast("long") for c in ("n", "n2", "at", "at2"))
    return (100 + percent) * F.least(n - i, m - j) >= percent * (n + m)


_PAIR = pa.schema([("a", _I64), ("b", _I64)])


def list_pairs(marked: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of one list that are in different components, not yet compared, and by
    their sizes and places can share enough. Long lists are cut into parts, and a group is
    one part against another: no list is held whole, and a crowded key is many groups (two
    groups with one hash only meet in vain). Pairs that cannot be alike are no rows."""
    def met(table: pa.Table):
        group, name, n, at, comp, spot, side = (table[c].to_numpy() for c in ("group", "set_id", "n", "at", "comp", "spot", "side"))
        new = np.concatenate([[True], group[1:] != group[:-1]])
        end = np.append(np.flatnonzero(new)[1:], len(group))[np.cumsum(new) - 1]
        # Rows of a group that lie 1, 2, 3... apart, for all groups at once.
        i, apart, held, size = np.arange(len(group)), 1, [], 0
        while len(i := i[i + apart < end[i]]):
            j = i + apart
            ok = (comp[i] != comp[j]) & ((spot[i] != spot[j]) | (spot[i] == 0)) & ((side[i] != side[j]) | (side[i] == 2))
            ok &= (100 + percent) * np.minimum(n[i] - at[i], n[j] - at[j]) >= percent * (n[i] + n[j])
            x, y = name[i[ok]], name[j[ok]]
            held.append((np.minimum(x, y), np.maximum(x, y)))
            size += len(x)
            if size > 100_000:
                yield _batch(_PAIR, map(np.concatenate, zip(*held)))
                held, size = [], 0
            apart += 1
        if size:
            yield _batch(_PAIR, map(np.concatenate, zip(*held)))

    def run(batches):
        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if carry is not None:
                table = pa.concat_tables([carry, table])
            group = table["group"].to_numpy()
            last = len(group) - int(np.argmax(group[::-1] != group[-1])) if group[0] != group[-1] else 0  # this group may go on
            if last:
                yield from met(table.slice(0, last))
            carry = table.slice(last)
        if carry is not None:
            yield from met(carry)

    size = marked.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / LIST_PART).alias("_parts"))
    cut = marked.join(size, "key").withColumn("_own", F.pmod(F.xxhash64("set_id"), F.col("_parts")))
    each = cut.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    group = F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other"))
    sent = each.select(group.alias("group"), "set_id", F.col("n").cast("long").alias("n"), F.col("at").cast("long").alias("at"), "comp",
                       F.coalesce("spot", F.lit(0)).alias("spot"), side.alias("side"))
    return sent.repartition("group").sortWithinPartitions("group").mapInArrow(run, "a long, b long").distinct()


def set_components(docs: DataFrame, shared: DataFrame, stored: DataFrame, of_set: DataFrame, k: int, percent: int) -> DataFrame:
    """``set_id, comp`` for every stored set."""
    comps = materialize(home_components(docs, stored, of_set, k, percent))
    # Where a set was compared already: equal for the sets of one block, else null.
    spot = F.when(F.col("home").isNotNull(), F.xxhash64("home", "block"))
    lists = shared.select("key", "set_id", "n", "at")
    for step in range(STARS + 1):
        marked = lists.join(comps.select("set_id", "comp", spot.alias("spot")), "set_id")
        live = marked.groupBy("key").agg(F.min(F.struct("comp", "set_id", "n", "at", "spot")).alias("c"), F.max("comp").alias("hi"))
        live = live.filter("c.comp < hi").select("key", "c")
        marked = materialize(marked.join(live if step < STARS else live.select("key"), "key"))
        if step < STARS:
            other = {"set_id": "a", "n": "n2", "at": "at2", "comp": "comp2", "spot": "spot2"}
            met = marked.select("*", *[F.col(f"c.{x}").alias(y) for x, y in other.items()]).filter("comp <> comp2")
            tested = F.coalesce(F.col("spot") == F.col("spot2"), F.lit(False))
            pairs = met.filter(~tested & _enough(percent)).select("a", F.col("set_id").alias("b")).distinct()
        else:
            pairs = list_pairs(marked, percent)
        links = materialize(linked_pairs(docs, pairs, stored, of_set, k, percent))
        if not links.isEmpty():
            comps = _merged(comps, links)
        lists = marked.select("key", "set_id", "n", "at")
    return comps.select("set_id", "comp")


def frequent_shingles(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in ascending order, and their ranks: rarer first."""
    top = found.filter("token is not null and not sampled").groupBy("token").agg(F.sum("seen").alias("seen")).orderBy(
        F.desc("seen"), "token").limit(FREQUENT).toArrow()
    tokens, seen = top["token"].to_numpy().view(np.uint64), top["seen"].to_numpy()
    by = np.argsort(tokens, kind="stable")
    return tokens[by], seen[by]


def list_length(found: DataFrame) -> float:
    """How many other sets a posting of a shingle that is not frequent meets, about."""
    per = found.filter("sampled").groupBy("token").agg(F.sum("seen").alias("df")).filter("df < 64")
    r = per.agg(F.sum(F.col("df") * (F.col("df") - 1)), F.sum("df")).first()
    return float(r[0] or 0) / float(r[1] or 1)


def jaccard_components(documents: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row (see ``op4``).

    Null, empty or blank text has no shingles and is linked with nothing: its component is
    its own id. A row with a null id is counted, but linked with nothing, and its component
    is null. Rows that repeat an id keep their own size, and are linked by their own text;
    repeated rows are repeated in the result. An empty table gives no rows. Other columns
    are ignored.
    """
    with small_batches(documents.sparkSession):
        return _components_of(documents.sparkSession, texts(documents), k, percent)


def _components_of(spark: SparkSession, docs: DataFrame, k: int, percent: int) -> DataFrame:
    found = materialize(profile(docs, k))
    rows = found.filter("n is not null")
    named = rows.filter("doc_id is not null and n > 0")
    sizes = {r["n"]: r["c"] for r in named.filter("n <= 256").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    limit = boundary(sizes, list_length(found), percent)
    frequent = spark.sparkContext.broadcast(frequent_shingles(found))
    shared = materialize(shared_keys(postings(docs.filter("doc_id is not null"), k, percent, limit, frequent), percent))

    # One document, and a block under its most crowded key, for every set that shares some
    # key: there a set meets most of those it is alike to. Where that is one other set, the
    # two are a pair like any other, and need no block.
    crowd = shared.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    blocks = shared.select("key", "set_id").join(crowd, "key").groupBy("set_id").agg(F.max(F.struct("c", "key")).alias("h")).select(
        "set_id", F.when(F.col("h.c") > 2, F.col("h.key")).alias("home"), F.pmod(F.col("set_id"), F.ceil(F.col("h.c") / BLOCK)).alias("block"))
    of_set = materialize(named.groupBy("set_id").agg(F.min("doc_id").alias("doc_id")))
    stored = materialize(bitmaps(docs, blocks.join(of_set, "set_id"), k))
    comps = set_components(docs, shared, stored, of_set, k, percent)

    # Smallest document of every component; a set that shares no key is alone.
    label = of_set.join(comps, "set_id", "left").select("set_id", "doc_id", F.coalesce("comp", "set_id").alias("comp"))
    label = materialize(label)
    low = label.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of = label.join(low, "comp").select("set_id", "component_id")
    linked = rows.join(of, "set_id", "left")
    own = F.col("doc_id").isNull() | (F.col("n") == 0)
    return linked.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
