"""Corpus preparation: five stages, each over all that the one before it kept.

A stage is (name, function of the session, the documents and the folder of tables).
All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm import decontaminate, pii, sentencepiece_bpe, simhash, toxicity
from coppice.llm.common import bounded_batches
from coppice.llm.queries import held_out, table
from coppice.store import Store


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier scores below 0.5; it learns from the labels outside the held-out fold."""
    model = toxicity.fit(docs, table(spark, folder, "labels").where(~held_out()))
    return toxicity.reject(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in benchmark windows."""
    return decontaminate.keep_clean(docs, table(spark, folder, "benchmark"))


def mask_private(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with personal data masked, and their new lengths."""
    bounded_batches(spark)
    masked = docs.withColumn("text", pii.masked_column("text"))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids of every text with the digests of ids and decoded text."""
    bounded_batches(spark)
    coded = docs.select("doc_id", "lang", "source", sentencepiece_bpe.encode_column().alias("coded"))
    picked = [f"coded.{c}" for c in ("n_tokens", "ids", "ids_sha256", "decoded_sha256")]
    return coded.select("doc_id", "lang", "source", *picked)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", mask_private),
    ("sentencepiece", encode),
]

#: Hashes, a trained classifier and a vocabulary are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    store = Store(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir), name)
    return docs
