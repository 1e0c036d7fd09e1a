"""Helpers the operators share: tables, words, held-out rows and components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.plans.checkpoint import shared_folder, staged  # noqa: F401 - used by the operators

# White space of the word rule: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold that no model learns from."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def connected(edges: DataFrame, name: str = "links") -> DataFrame:
    """``node, component_id`` for every node on an edge ``a, b`` of longs.

    Large-star and small-star steps in turn, until the edges stay the same. A
    step joins edges with one minimum per node, summed up before the shuffle, so
    a node with very many links never gathers them in one task. Each round is
    staged; all that reaches the driver is a count and a checksum.
    """
    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    def tidy(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct()

    current = staged(tidy(edges.select("a", "b")), name)
    sign = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = least(both).select("a", F.least("a", "m").alias("m"))
        large = tidy(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = least(large)
        joined = large.join(low, "a")
        current = staged(tidy(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
        ), name)
        found = current.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if found == sign:
            break
        sign = found
    # Every edge now leads to the smallest node of its component.
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component_id")).unionByName(roots)
