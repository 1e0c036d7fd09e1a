"""From raw documents to token ids, in stages that are each written down before the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, exact_dedup, minhash, mixing, quality
from lodestone.llm.common import held_out, shared_folder, table
from lodestone.session import configure


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores at or above the threshold."""
    configure(spark)
    labels = table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, ~held_out(F.col("doc_id"), 4, 2))
    return quality.good_rows(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space."""
    configure(spark)
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    configure(spark)
    return minhash.without_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    configure(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number and the digest of what they decode to."""
    configure(spark)
    coded = bpe.encode_decode(docs)
    return bpe.digests(coded, "ids")


STAGES = [("quality", good), ("exact", exact), ("near", near), ("mix", mixed), ("bpe", tokens)]
# The model scores and the token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
