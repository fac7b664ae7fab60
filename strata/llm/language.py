"""Language identification by Bayesian fusion of several kinds of evidence.

For each language, the posterior is the product of

* the likelihood of the text under a character trigram model, trained here on a bounded
  sample of labelled documents; trigrams of a text are not independent, so its weight is
  that of ``STRENGTH`` of them at most, spread over the whole text;
* the likelihood of the declared language tag (document metadata, or ``lang`` of the
  markup), which may be wrong: how often a tag goes with each language is counted;
* the likelihood of the address suffix, counted in the same way;
* the prior of the host, smoothed towards that of its domain, that towards its suffix, and
  that towards all texts, so a host with few pages says little.

Counts are taken over all texts, by grouped aggregation of the text model's own verdicts.
A last hypothesis, ``OTHER``, is a model of random characters: text that it explains better
than any language is rejected, as is text without letters or without a clear winner.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import or_empty, parts, small_batches
from strata.plans.sizing import broadcast_if_small, materialize

OTHER = "und"
BUCKETS = 1 << 14
SAMPLE_DOCS = 4_000  # labelled documents the text model is trained on, about; a fixed bound
SAMPLE_CHARS = 200_000  # of each of them at most
STRENGTH = 40.0
OTHER_PRIOR = 0.01
SMOOTH = 20.0  # rows' worth of a parent's opinion in its child's
ACCEPT = 0.6
_STEP = 1 << 20  # characters of a text worked on at once


def trigrams(text: str):
    """Buckets of the trigrams of a text, in lower case, padded with blanks; part by part,
    so that a long text needs no memory of its length."""
    low = f" {text.lower()} "
    for at in range(0, max(len(low) - 2, 0), _STEP):
        c = np.frombuffer(low[at:at + _STEP + 2].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        mixed = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)) * np.uint64(0x27D4EB2F165667C5)
        yield (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


class TextModel:
    """Log-probabilities of trigram buckets for each language, then for ``OTHER``."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        rows = [np.log((counts[l] + 0.05) / (counts[l].sum() + 0.05 * BUCKETS)) for l in self.languages]
        self.table = np.ascontiguousarray(np.array([*rows, np.full(BUCKETS, -math.log(BUCKETS))]).T)

    def score(self, text: str) -> tuple[list[float], int]:
        """Log-likelihoods at the strength of a text, and its letters."""
        total, n = np.zeros(self.table.shape[1]), 0
        for part in trigrams(text):
            total += np.bincount(part, minlength=BUCKETS) @ self.table if len(part) > BUCKETS // 4 else self.table[part].sum(axis=0)
            n += len(part)
        letters = sum(map(str.isalpha, text[:200])) or sum(map(str.isalpha, text))
        return (total * (min(1.0, STRENGTH / n) if n else 0.0)).tolist(), letters


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> TextModel:
    """A text model from ``text, language``. Documents are sampled by hash at a rate that
    gives about ``sample_docs`` in all, but every language as large a share as it needs to
    be a quarter of what an even split gives it."""
    rows = labelled.filter("language is not null and text is not null and language <> ''")
    sizes = {r["language"]: r["n"] for r in rows.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = sample_docs / max(len(sizes), 1)
    picked = None
    for name, n in sizes.items():
        rate = min(1.0, share / n)
        part = (F.col("language") == name) & (F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(rate * (1 << 20)))
        picked = part if picked is None else picked | part
    if picked is None:
        return TextModel({})

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in parts(batches):
            for text, name in zip(batch.column("text").to_pylist(), batch.column("language").to_pylist()):
                to = held.setdefault(name, np.zeros(BUCKETS, np.int64))
                for part in trigrams(text[:SAMPLE_CHARS]):
                    to += np.bincount(part, minlength=BUCKETS)
        for name, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(n[at])], names=["language", "bucket", "n"])

    counted = rows.filter(picked).select("text", "language").mapInArrow(count, "language string, bucket long, n long")
    counts: dict[str, np.ndarray] = {}
    for r in counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts.setdefault(r["language"], np.zeros(BUCKETS))[r["bucket"]] = r["n"]
    return TextModel(counts)


def scored(df: DataFrame, model: TextModel, text: str) -> DataFrame:
    """All columns but ``text``, and ``_ll array<double>``, ``_letters``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    others = [c for c in df.columns if c != text]
    fields = df.select(*others).schema

    def run(batches):
        m = shared.value
        for batch in parts(batches):
            found = [m.score(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array([f[0] for f in found], pa.list_(pa.float64())), pa.array([f[1] for f in found], pa.int64())],
                names=[*others, "_ll", "_letters"])

    schema = T.StructType([*fields, T.StructField("_ll", T.ArrayType(T.DoubleType())), T.StructField("_letters", T.LongType())])
    return df.mapInArrow(run, schema)


def _counts(verdicts: DataFrame, by: str, size: int) -> DataFrame:
    """``by``, and how many of its rows the text model gives to each language."""
    each = [F.count(F.when(F.col("_best") == i, 1)).cast("double") for i in range(size)]
    return verdicts.filter(F.col(by).isNotNull()).groupBy(by).agg(F.array(*each).alias("_n"))


def _smoothed(counts: Column, parent: Column) -> Column:
    """Prior with the weight of ``SMOOTH`` rows of its parent's."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(counts, parent, lambda n, p: (n + SMOOTH * p) / (total + SMOOTH))


def _tag(tag: Column) -> Column:
    """First part of a tag like ``en-GB``, in lower case; empty is null."""
    t = F.lower(F.regexp_extract(tag, r"^\s*([A-Za-z]+)", 1))
    return F.when(t != "", t)


def identify(rows: DataFrame, model: TextModel, text: str = "text", wide: bool = False) -> DataFrame:
    """Adds ``language`` (null if rejected), ``confidence`` to rows that have ``text``,
    ``host``, ``domain``, ``suffix`` and ``declared`` (each may be null), and takes these
    away. A host is within its domain, a domain within its suffix.

    What the text model says is stored beside a row's other columns. Where these are
    ``wide``, only what is counted is stored, and texts are scored a second time."""
    if not model.languages:
        return rows.drop("host", "domain", "suffix", "declared", text).withColumns(
            {"language": F.lit(None).cast("string"), "confidence": F.lit(0.0)})
    size = len(model.languages)
    evidence = ["host", "domain", "suffix", "declared"]
    inner = F.slice("_ll", 1, size)
    told = lambda frame: scored(frame, model, text).withColumn("_best", F.array_position(inner, F.array_max(inner)) - 1)
    stored = materialize(told(rows.select(text, *evidence)).drop("_ll") if wide else told(rows))
    sure = stored.filter("_letters > 0")

    total = sure.agg(F.count(F.lit(1)), *[F.count(F.when(F.col("_best") == i, 1)) for i in range(size)]).first()
    overall = [(n + 1.0) / (total[0] + size) for n in total[1:]]
    top = F.array(*[F.lit(p) for p in overall])

    # Priors of suffixes, domains and hosts, each smoothed by the one above it.
    suffix = _counts(sure, "suffix", size).select("suffix", _smoothed(F.col("_n"), top).alias("_ps"))
    above = sure.filter("domain is not null").groupBy("domain").agg(F.min("suffix").alias("suffix"))
    domain = _counts(sure, "domain", size).join(above, "domain").join(suffix, "suffix", "left").select(
        "domain", _smoothed(F.col("_n"), F.coalesce("_ps", top)).alias("_pd"))
    above = sure.filter("host is not null").groupBy("host").agg(F.min("domain").alias("domain"))
    host = _counts(sure, "host", size).join(above, "host").join(domain, "domain", "left").select(
        "host", _smoothed(F.col("_n"), F.coalesce("_pd", top)).alias("_prior"))
    # How often a tag or suffix is seen with each language: n(tag, language) / n(language).
    per = F.array(*[F.lit(float(n) + 1.0) for n in total[1:]])
    share = lambda name: F.zip_with(F.col("_n"), per, lambda n, t: (n + 0.5) / t).alias(name)
    tags = _counts(sure, "declared", size).select("declared", share("_tag"))
    endings = _counts(sure, "suffix", size).select("suffix", share("_end"))

    joined = told(rows) if wide else stored
    for side, key in ((host, "host"), (tags, "declared"), (endings, "suffix")):
        joined = joined.join(broadcast_if_small(side), key, "left")
    even = F.array(*[F.lit(1.0)] * size)
    weight = F.coalesce("_prior", top)
    for c in ("_tag", "_end"):
        weight = F.zip_with(weight, F.coalesce(c, even), lambda a, b: a * b)
    # OTHER has the mean of what the languages have, at its own prior.
    mean = F.aggregate(weight, F.lit(0.0), lambda s, x: s + x) / F.lit(float(size))
    logs = F.zip_with(F.col("_ll"), F.array_append(weight, OTHER_PRIOR * mean * size), lambda l, w: l + F.log(w))
    joined = joined.withColumn("_log", logs)
    best = F.array_max("_log")
    mass = F.aggregate(F.transform("_log", lambda x: F.exp(x - best)), F.lit(0.0), lambda s, x: s + x)
    names = F.array(*[F.lit(n) for n in [*model.languages, OTHER]])
    winner = F.get(names, (F.array_position("_log", best) - 1).cast("int"))
    joined = joined.withColumn("_winner", winner).withColumn("confidence", 1.0 / mass)
    accepted = (F.col("_letters") > 0) & (F.col("_winner") != OTHER) & (F.col("confidence") >= ACCEPT)
    others = [c for c in rows.columns if c not in (text, *evidence)]
    return joined.select(*others, F.when(accepted, F.col("_winner")).alias("language"), "confidence")


def identify_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, language, confidence, accepted`` for every row of ``documents`` (text,
    lang, source): lang is a declared tag, source stands for the host, and the text model
    is trained on a sample of rows by their tag.

    Null, blank or letterless text is rejected (``language`` null); a null tag or source is
    no evidence; repeated and null ids keep their rows; without any tag there is no model
    and nothing is accepted; an empty table gives no rows. Other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty("text").alias("text"), F.col("source").cast("string").alias("host"),
                            F.lit(None).cast("string").alias("domain"), F.lit(None).cast("string").alias("suffix"), _tag(F.col("lang")).alias("declared"))
    model = train(rows.select("text", F.col("declared").alias("language")))
    return identify(rows, model).select("doc_id", "language", "confidence", F.col("language").isNotNull().alias("accepted"))


def accepted_documents(documents: DataFrame) -> DataFrame:
    """Rows of ``documents`` with an accepted language, all their columns, ``lang`` replaced
    by the language found. The text travels along with what is found out about it, so no
    row has to be looked up again by its id; it is not stored on the way."""
    held = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(documents.columns)]
    rows = documents.select(*held, or_empty("text").alias("text"), F.col("source").cast("string").alias("host"),
                            F.lit(None).cast("string").alias("domain"), F.lit(None).cast("string").alias("suffix"), _tag(F.col("lang")).alias("declared"))
    model = train(rows.select("text", F.col("declared").alias("language")))
    with small_batches(documents.sparkSession):
        found = identify(rows, model, wide=True).filter("language is not null")
    return found.select(*[F.col("language" if c == "lang" else f"_c{i}").alias(c) for i, c in enumerate(documents.columns)])


def visible_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags give way to a blank."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")


def identify_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """``page_id, language, confidence, accepted`` for every row of ``pages`` (url, html),
    with the text model of ``documents``, the ``lang`` of the page's markup, its host,
    domain (last two labels) and address suffix. Same rules as ``identify_documents``."""
    tagged = documents.select(or_empty("text").alias("text"), _tag(F.col("lang")).alias("language"))
    host = F.lower(F.regexp_extract("url", "(?s)^.*?://([^/?#:]*)", 1))
    host = F.when(host != "", host)
    html = or_empty("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), visible_text(html).alias("text"), host.alias("host"),
        F.substring_index(host, ".", -2).alias("domain"), F.substring_index(host, ".", -1).alias("suffix"),
        _tag(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]*)", 1)).alias("declared"))
    return identify(rows, train(tagged)).select("page_id", "language", "confidence", F.col("language").isNotNull().alias("accepted"))
