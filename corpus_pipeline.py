"""Corpus pipeline: documents through five stages, each written as Parquet and read again.

Part of the subpackage landrank.llm.  Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.llm import jaccard, mixing, pii, segment, toxicity
from landrank.llm.common import table, written

#: Words of a shingle and least Jaccard similarity of near duplicates.
SHINGLE, SIMILAR = 5, 0.8


def aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """docs without columns of these names, which an operator puts in for its own, and the columns that bring docs' own back."""
    own = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(own), [F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of the training folds.

    Null and empty texts score as texts without a word, very long ones whole; rows that repeat are judged alike, so all
    stay or go; no rows give no rows, and without labels of 1 nothing is rejected; further columns stay as they are.
    """
    free, columns = aside(docs, ("score", "threshold", "rejected"))
    return toxicity.toxicity(free, table(spark, sf_dir, "labels")).filter(~F.col("rejected")).select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id (and text hash) stays, once.

    Null and empty texts, and rows with a null doc_id, link with nothing and stay; very long texts are compared whole; a
    row that repeats a doc_id is judged by its own text; of rows that repeat both one stays; no rows give no rows;
    further columns stay as they are.
    """
    groups = written(jaccard.jaccard_groups(docs.select("doc_id", "text"), SHINGLE, SIMILAR), "groups").filter("doc_id is not null and n_shingles > 0")
    gone = groups.filter("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    rows = rows.join(gone, (F.col("id") == F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")), "left_anti")
    twice = groups.filter("kept").groupBy("doc_id", "text_hash").count().filter("count > 1").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    if not twice.isEmpty():
        same = (F.col("id") == F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
        once = rows.join(twice, same, "left_semi").groupBy("id", "hash").agg(F.first("row").alias("row"))
        rows = rows.join(twice, same, "left_anti").select("row").unionByName(once.select("row"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in cols])


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities get surrogates; n_chars follows the text.

    Null texts stay null (n_chars null), empty ones empty; very long ones are searched whole; rows that repeat get the
    same text; no rows give no rows; further columns are carried along, whatever their names.
    """
    free, columns = aside(docs, ("entities",))
    return pii.surrogates(free).withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it.

    Null and empty texts have no words and are never taken; a null source is a source; rows that repeat are documents of
    their own; no rows give no rows; a very long text is one document; further columns are carried along, whatever their
    names.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the sampled piece ids of each row and their number.

    Null and empty texts have no ids; very long ones are segmented whole; rows that repeat a doc_id and text get the same
    ids; no rows give no rows; other columns are left out.
    """
    return segment.encode(docs.select("doc_id", "source", "text")).select("doc_id", "source", "ids", F.size("ids").alias("n_pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL does not express the classifier's, the surrogates' and the sampler's stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
