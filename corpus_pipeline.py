"""From documents to training sequences: toxic documents and near-duplicates go, secrets are masked, sources are mixed, the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.llm import mixing, packing, secret_scan, simhash, toxicity
from wattfolio.llm.common import stored, table
from wattfolio.llm.queries import qualities


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the stage's own input and the labels."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within three bits stays."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; a text that changes gets its new length."""
    masked = secret_scan.redacted(docs, secret_scan.scan(docs))
    size = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.withColumn("n_chars", size)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1 in turn; a document is repeated up to three times."""
    return mixing.sampled(docs, qualities(table(spark, sf_dir, "labels"), docs), weights=(5, 2, 1), share=1.0, repeat=3)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the sequences of 1024 words that hold them."""
    return packing.pack(docs, capacity=1024)


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("source_mixing", mixture),
    ("best_fit_packing", sequences),
]

# Training and packing are no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, name)
    return docs
