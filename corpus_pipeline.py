"""Stages that turn `documents` into packed training sequences.

Toxic documents go, one document of each near-duplicate component stays, secrets in the texts are
replaced by a mark, and what is left is packed into sequences of 1024 tokens. Near-duplicates are
texts whose SimHash fingerprints over three-word shingles are linked by at most two differing bits.

Cases: a null text is empty to every stage, and stays null until it is packed; a row with a null
id stands behind the others of its component. An empty table gives an empty result. Columns beyond
those of `documents` are kept up to the packing.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.llm import packing, secrets, simhash, toxicity
from txscore.llm.queries import held_out
from txscore.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7, by a model of the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, ~held_out(F.col("doc_id"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the least id."""
    return simhash.one_of_each(docs, words=3)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts hidden and characters counted anew."""
    cleaned = secrets.redact(docs, secrets.train(docs))
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and their place in it."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_spans),
    ("packing", packed),
]

# models and components cannot be said in SQL; tests hold the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
