"""From raw documents to token ids: five stages, each written and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodplan.llm import decontaminate, pieces, quality, secrets, simhash
from floodplan.llm.queries import PIECES, vocabulary
from floodplan.llm.text import small_batches
from floodplan.session import shared_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link: that with the smallest id."""
    small_batches(spark)
    return simhash.drop_near_copies(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.mask_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens and ids of every document."""
    small_batches(spark)
    found = pieces.encoded(docs.select("doc_id", "lang", "source", "n_chars", "text"), vocabulary(PIECES))
    return found.select(
        "row.doc_id",
        "row.lang",
        "row.source",
        "row.n_chars",
        F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long").alias("n_tokens"),
        "ids",
    )


STAGES = [
    ("quality", good_quality),
    ("near_copies", distinct),
    ("benchmark", clean_of_benchmark),
    ("secrets", masked),
    ("tokens", tokens),
]

#: The classifier's fit is no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
