"""Order-independent document fingerprints: a homomorphic multiset hash.

A text is the multiset of its paragraphs (pieces that end with a line break or a full
stop; the pieces joined are the text again). Each paragraph is hashed to a wide vector,
and the fingerprint is the sum of these vectors, lane by lane, modulo a power of two:

* ``KEYS`` x 2 lanes of 32 random bits, modulo 2^32, decide equality;
* 64 lanes of one random bit, modulo 2^16, measure how much two multisets share: with
  bits read as +1 and -1, the inner product of two fingerprints estimates the inner
  product of the two multisets (a tug-of-war sketch);
* one lane counts paragraphs.

Because it is a sum, ``combine`` of two fingerprints is the fingerprint of both texts'
paragraphs together, and ``remove`` takes paragraphs out again, without the texts.
DataFrame functions only; nothing here runs Python on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import texts

KEYS = 8  # independent 64-bit hashes for equality, 16 lanes of 32 bits
SIGNS = 64
_PAIR = (1 << 32) | 1  # two bits, 32 places apart
_LOW = (1 << 32) - 1
PARAGRAPH_END = "(?<=[\n.])(?=[^\n.])"


def paragraphs(text: Column) -> Column:
    """Pieces that joined give the text; the empty text is one empty piece."""
    return F.split(text, PARAGRAPH_END)


def _lanes(unit: Column) -> list[Column]:
    """Aggregates over exploded paragraphs: raw sums, two lanes in each."""
    out = []
    for k in range(KEYS):
        h = F.xxhash64(F.lit(k), unit)
        out += [F.sum(h.bitwiseAND(F.lit(_LOW))), F.sum(F.shiftrightunsigned(h, 32))]
    h = F.xxhash64(F.lit(KEYS), unit)
    out += [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_PAIR))) for j in range(SIGNS // 2)]
    return out + [F.count(F.lit(1))]


def _vector(raw: Column) -> Column:
    """Lanes out of raw sums, each modulo its power of two."""
    keys = F.transform(F.slice(raw, 1, 2 * KEYS), lambda v: v.bitwiseAND(F.lit(_LOW)))
    packed = F.slice(raw, 2 * KEYS + 1, SIGNS // 2)
    low = F.transform(packed, lambda v: v.bitwiseAND(F.lit(0xFFFF)))
    high = F.transform(packed, lambda v: F.shiftrightunsigned(v, 32).bitwiseAND(F.lit(0xFFFF)))
    count = F.slice(raw, 2 * KEYS + SIGNS // 2 + 1, 1)
    return F.concat(keys, low, high, count)


def _fold(vector: Column) -> Column:
    at = F.transform(vector, lambda v, i: F.when(i < 2 * KEYS, v.bitwiseAND(F.lit(_LOW)))
                     .when(i < 2 * KEYS + SIGNS, v.bitwiseAND(F.lit(0xFFFF))).otherwise(v))
    return at


def combine(a: Column, b: Column) -> Column:
    """Vector of both multisets together; order does not matter."""
    return _fold(F.zip_with(a, b, lambda x, y: x + y))


def remove(a: Column, b: Column) -> Column:
    """Vector of ``a`` without the paragraphs of ``b``, which must be among them."""
    return _fold(F.zip_with(a, b, lambda x, y: x - y))


def as_hex(vector: Column) -> Column:
    """Fixed-width text: 8 digits for each key lane and the count, 4 for each sign lane."""
    digits = F.transform(vector, lambda v, i: F.lower(F.lpad(
        F.hex(v), F.when((i >= 2 * KEYS) & (i < 2 * KEYS + SIGNS), 4).otherwise(8), F.lit("0"))))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: estimate of 2 x shared / (all of a + all of b), by the sign lanes; exactly
    1 for equal vectors. The standard error is about 0.13 for unlike texts."""
    n_a, n_b = F.element_at(a, -1), F.element_at(b, -1)
    signed = lambda v, n: F.transform(F.slice(v, 2 * KEYS + 1, SIGNS), lambda c: (2 * c - n).cast("double"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    x, y = signed(a, n_a), signed(b, n_b)
    shared = 2 * total(F.zip_with(x, y, lambda p, q: p * q))
    full = total(F.zip_with(x, y, lambda p, q: p * p + q * q))
    near = F.when(full > 0, shared / full).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.greatest(near, F.lit(0.0)), F.lit(1.0)))


def fingerprint(df: DataFrame, keys: list[str], text: str = "text", out: str = "vector") -> DataFrame:
    """One row per distinct ``keys``: the vector of all paragraphs of its rows. Partial
    sums are formed before any shuffle, so a key with many rows sends one row per task."""
    units = df.select(*keys, F.explode(paragraphs(F.col(text))).alias("_unit"))
    sums = _lanes(F.col("_unit"))
    wide = units.groupBy(*keys).agg(*[s.alias(f"_s{i}") for i, s in enumerate(sums)])
    return wide.select(*keys, _vector(F.array(*[F.col(f"_s{i}") for i in range(len(sums))])).alias(out))


def _bounds(docs: DataFrame, bucket_bytes: int) -> tuple[list[int], bool]:
    """Ids at which buckets begin (every bucket has rows), the smallest id first, and
    whether some id is null. The list is bounded by bytes of text / ``bucket_bytes``."""
    size, low, nulls = docs.agg(
        F.sum(F.octet_length("text")), F.min("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1))
    ).first()
    if low is None:
        return [], bool(nulls)
    n = int((size or 0) // bucket_bytes) + 1
    cuts = []
    if n > 1:
        at = [i / n for i in range(1, n)]
        cuts = docs.agg(F.percentile_approx("doc_id", at, F.lit(10 * n + 1000)).alias("c")).first()["c"]
    return sorted({low, *(c for c in cuts if c is not None)}), bool(nulls)


def _bucket(id_: Column, bounds: list[int]) -> Column:
    """How many bounds after the first are <= id: two short scans, not one over all."""
    rest = bounds[1:]
    if not rest:
        return F.lit(0)
    step = max(1, int(len(rest) ** 0.5))
    tops = F.array(*[F.lit(v) for v in rest[::step]])
    blocks = F.array(*[F.array(*[F.lit(v) for v in rest[i:i + step]]) for i in range(0, len(rest), step)])
    block = F.size(F.filter(tops, lambda v: v <= id_))
    inside = F.size(F.filter(F.get(blocks, block - 1), lambda v: v <= id_))
    return F.when(id_.isNull() | (block == 0), 0).otherwise((block - 1) * step + inside)


def with_next(docs: DataFrame, bucket_bytes: int = 32 << 20) -> DataFrame:
    """Rows ``doc_id, text`` in buckets of ascending ids, each with the text of the next
    row (ascending id, nulls first, equal ids by text; after the last comes the first).

    No global order is made: buckets are id ranges of about ``bucket_bytes`` of text, and
    the first row of each bucket is also sent to the one before it, as a ghost at its
    end. Ghosts are kept (``_ghost``), so that callers can look one row ahead once more.
    One shuffle of the texts.
    """
    bounds, nulls = _bounds(docs, bucket_bytes)
    n = max(1, len(bounds))
    id_ = F.col("doc_id")
    rows = docs.withColumn("_bucket", _bucket(id_, bounds)).withColumn("_ghost", F.lit(False))
    head = id_.isNull() if nulls else id_.eqNullSafe(F.lit(bounds[0] if bounds else None).cast("long"))
    first = head | id_.isin(bounds[1:]) if n > 1 else head
    ghosts = rows.filter(first).select(
        "doc_id", "text", F.pmod(F.col("_bucket") - 1, F.lit(n)).alias("_bucket"), F.lit(True).alias("_ghost"))
    in_order = Window.partitionBy("_bucket").orderBy("_ghost", F.asc_nulls_first("doc_id"), "text")
    return (rows.unionByName(ghosts)
            .withColumn("_at", F.row_number().over(in_order))
            .withColumn("_next", F.lead("text").over(in_order)))


def edited_documents(documents: DataFrame, bucket_bytes: int = 32 << 20) -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``op10``).

    Null text is empty; equal ids are ordered by text; one row per input row, repeated
    rows included; a table of one row has itself as next; an empty table gives no rows.
    Other columns of the input are ignored, whatever their names.
    """
    placed = with_next(texts(documents), bucket_bytes)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    both = placed.select(
        "_bucket", "_at", "_ghost", "doc_id", n.cast("long").alias("n_chars"), F.col("text").alias("_own"),
        F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                 F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half)).alias("_edited"),
    )
    # The keys contain the bucket, by which rows already lie together: no further shuffle.
    keys = ["_bucket", "_at", "_ghost", "doc_id", "n_chars", "edited_sha256"]
    sided = both.withColumn("edited_sha256", F.when(~F.col("_ghost"), F.sha2(F.col("_edited"), 256))).select(
        *keys, F.explode(F.when(F.col("_ghost"), F.array(F.struct(F.lit(0).alias("side"), F.col("_own").alias("text"))))
                         .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("_own").alias("text")),
                                            F.struct(F.lit(1).alias("side"), F.col("_edited").alias("text"))))).alias("_t"))
    vectors = fingerprint(sided.select(*keys, "_t.side", "_t.text"), [*keys, "side"])
    pair = vectors.groupBy(*keys).agg(
        F.max(F.when(F.col("side") == 0, F.col("vector"))).alias("a"),
        F.max(F.when(F.col("side") == 1, F.col("vector"))).alias("e"))
    ahead = pair.withColumn("b", F.lead("a").over(Window.partitionBy("_bucket").orderBy("_at")))
    return ahead.filter(~F.col("_ghost")).select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("a")).alias("fingerprint"),
        as_hex(F.col("e")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("e")).alias("near_edited"),
        likeness(F.col("a"), F.col("b")).alias("near_next"))
