"""From raw documents to piece ids: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm import decontaminate, pieces, pii, simhash, toxicity
from tasteloom.llm.common import id_hash, table
from tasteloom.sources.scratch import remove, removed_at_end, scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic.

    It learns from labels of documents whose crc32 leaves a remainder other than 0 by 5. Without labels
    of both classes all documents stay.
    """
    trains = F.coalesce(id_hash("doc_id") % 5 != 0, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), trains)
    return docs.where(toxicity.score(F.col("text"), model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest by id, of each group of fingerprints over three words that two bits or fewer link."""
    return simhash.one_of_each(docs, words=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also none with one edit in ten characters."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_identifiers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.with_masked(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it."""
    own = docs.select("doc_id", "lang", "source", "text")
    encoded = pieces.with_ids(own, pieces.Vocabulary.load(), check="round_trip")
    return encoded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_identifiers),
    ("sentencepiece", encode),
]

# A trained classifier, fingerprints and a graph of contexts are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is a table before the next stage reads it.

    A stage's own intermediate tables are deleted once its result is written, and that once the next has read it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        with removed_at_end(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
