"""The corpus pipeline: from raw documents to packed token sequences.

Stages take and return the columns of documents, whatever columns there are beside them;
only the last returns pieces of sequences. Each is written as Parquet and read again, so a
lost executor costs a re-read of the stage before. A stage looks at all its predecessor
kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, language, ngram_join, packing, pii
from strata.llm.common import small_batches, table
from strata.plans.sizing import broadcast_if_small, materialize


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column has, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _row_key() -> Column:
    """Equal for rows that are alike in id and text, so that what is found out about a row
    finds its way back, even where ids repeat or are null."""
    return F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.coalesce(F.col("text"), F.lit("")))


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a clear language; ``lang`` becomes what was found. Null, blank and
    letterless texts go, as do texts that look like no language."""
    return language.accepted_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose sets of five-word shingles are alike to 0.8 or more: the
    one with the smallest id, then text. Rows of one id are judged each by its own text; if
    they are equal, one stays. Texts without words, and rows without an id, are in no group
    and stay."""
    key = _free(docs, "_copy")
    # Rows alike in id and text have one key, rows without an id none, which joins nothing.
    row = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit(""))))
    found = ngram_join.jaccard_components(docs.select(row.alias("doc_id"), "text"), k=5, percent=80)
    # The component is named after one of its rows; with the others these are its members.
    others = materialize(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_row"), "component_id").distinct())
    members = broadcast_if_small(others.unionByName(others.select(F.col("component_id").alias("_row"), "component_id")).distinct())
    rows = docs.select(row.alias("_row"), F.col("doc_id").cast("long").alias("_id"), "text")
    ids = materialize(rows.select("_row", "_id").join(members, "_row").distinct())
    lowest = broadcast_if_small(ids.groupBy("component_id").agg(F.min("_id").alias("_id")))
    first = materialize(ids.join(lowest, ["component_id", "_id"]).select("_row", "component_id"))
    # Texts are compared only where the smallest id has several rows in the component.
    tied = first.groupBy("component_id").count().filter("count > 1").select("component_id")
    tied = broadcast_if_small(first.join(broadcast_if_small(tied), "component_id", "left_semi"))
    best = rows.select("_row", "text").join(tied, "_row").groupBy("component_id").agg(F.min_by("_row", "text").alias("_row"))
    lost = tied.select("_row").join(broadcast_if_small(best), "_row", "left_anti")
    leaves = broadcast_if_small(ids.join(broadcast_if_small(first), "_row", "left_anti").select("_row").unionByName(lost).withColumnRenamed("_row", key))
    stay = docs.withColumn(key, row).join(leaves, key, "left_anti").select(*docs.columns)
    # Only rows whose id repeats are compared by their text.
    repeated = broadcast_if_small(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    once = stay.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    again = stay.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands, word for word or slightly edited."""
    key = _free(docs, "_row")
    keyed = docs.withColumn(key, _row_key())
    found = decontamination.matches(keyed.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    with small_batches(spark):
        hit = broadcast_if_small(found.select(F.col("doc_id").alias(key)).distinct())
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _with_length(pii.redact(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2,048 ids (see ``op6``)."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# Language models, edit distances and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
