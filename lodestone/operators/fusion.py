"""Putting keyword and vector candidates into one order.

Both candidate lists are bounded by the limit of the search, so what is joined
and ranked here has a few hundred rows whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.config import SearchSettings
from lodestone.operators.keyword import (
    cover_rank,
    in_scope,
    keyword_search,
    text_matches,
    top_by,
    web_query,
)
from lodestone.operators.vectors import vector_scores, vector_search
from lodestone.plans.checkpoint import staged


def _ranked(rows: DataFrame, score: str, name: str) -> DataFrame:
    order = Window.orderBy(F.col(score).desc(), F.col("id"))
    return rows.withColumn(name, F.row_number().over(order))


def rrf(
    keyword: DataFrame, vector: DataFrame, limit: int, settings: SearchSettings = SearchSettings()
) -> DataFrame:
    """Reciprocal rank fusion of two candidate lists with the same columns.

    Every candidate gets a rank in both lists. One that only has words counts
    with a cosine of zero, and one that only has a vector with a keyword score
    of zero. Ties keep the merged order: keyword candidates, then the others.
    """
    left = _ranked(keyword, "keyword_score", "_kpos")
    right = _ranked(vector, "vector_score", "_vpos")
    shared = [c for c in left.columns if c in right.columns and c != "id"]
    merged = left.alias("k").join(right.alias("v"), "id", "full_outer").select(
        "id",
        *[
            F.when(F.col("_kpos").isNotNull(), F.col(f"k.{c}")).otherwise(F.col(f"v.{c}")).alias(c)
            for c in shared
        ],
        F.coalesce("keyword_score", F.lit(0.0)).alias("keyword_score"),
        F.coalesce("vector_score", F.lit(0.0)).alias("vector_score"),
        F.struct(F.col("_kpos").isNull().alias("late"), F.coalesce("_kpos", "_vpos").alias("at")).alias("_pos"),
    )

    def rank(score: str) -> Column:
        return F.row_number().over(Window.orderBy(F.col(score).desc(), "_pos")) - 1

    fused = merged.withColumn("keyword_rank", rank("keyword_score")).withColumn(
        "vector_rank", rank("vector_score")
    )
    score = F.lit(1.0) / (settings.rrf_k + F.col("keyword_rank")) + F.lit(1.0) / (
        settings.rrf_k + F.col("vector_rank")
    )
    return (
        fused.withColumn("score", score)
        .orderBy(F.col("score").desc(), "_pos")
        .limit(settings.limit(limit))
        .drop("_pos")
    )


def fetched(chunks: DataFrame, fused: DataFrame) -> DataFrame:
    """The rows of fused ids, best first.

    The ids are written down first, so Spark knows how few they are and reads
    the rows by a broadcast of them.
    """
    scores = staged(fused.select(
        "id", "keyword_score", "vector_score", "keyword_rank", "vector_rank", "score"
    ), "fused")
    # With equal scores, the order of the keyword list comes first.
    return chunks.join(scores, "id").orderBy(F.col("score").desc(), "keyword_rank")


def search_rrf(
    chunks: DataFrame,
    query_vector: Sequence[float],
    query: str,
    limit: int = 10,
    *,
    repo: str | None = None,
    branch: str | None = None,
    settings: SearchSettings = SearchSettings(),
    id_words: int = 1,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Hybrid search by rank.

    Words are searched on the texts and vectors on ``id, repo, branch, embedding``
    alone, from ``vectors`` where they are stored apart. Whole rows are read for
    the fused ids only.
    """
    text = (query or "").strip()
    take = settings.candidates(limit)
    words = keyword_search(chunks, text, take, repo=repo, branch=branch, id_words=id_words)
    apart = (chunks if vectors is None else vectors).select("id", "repo", "branch", "embedding")
    near = vector_search(apart, query_vector, take, repo=repo, branch=branch)
    return fetched(chunks, rrf(words, near.select("id", "vector_score"), limit, settings))


def search_weighted(
    chunks: DataFrame,
    query_vector: Sequence[float],
    query: str,
    limit: int = 10,
    *,
    repo: str | None = None,
    branch: str | None = None,
    settings: SearchSettings = SearchSettings(),
    english: bool = True,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Hybrid search by weighted scores, over rows that carry ``lexemes``.

    Texts are matched and ranked once, without vectors, which are scored apart, from
    ``vectors`` where they are stored apart. Each candidate of either list takes its other
    score as well, and whole rows are read for the best candidates only. An empty
    query ranks by vector alone.
    """
    text = (query or "").strip()
    apart = (chunks if vectors is None else vectors).select("id", "repo", "branch", "embedding")
    near = top_by(
        vector_scores(apart, query_vector, repo=repo, branch=branch), "vector_score",
        settings.candidates(limit) if text else settings.limit(limit),
    ).select("id", "vector_score")
    if not text:
        scored = near.withColumn("keyword_score", F.lit(0.0))
    else:
        wanted = web_query(text, english)
        rows = in_scope(chunks, repo, branch).where(text_matches(F.col("lexemes"), wanted))
        matching = staged(rows.select("id", cover_rank(F.col("lexemes"), wanted).alias("keyword_score")), "matching")
        words = top_by(matching, "keyword_score", settings.candidates(limit))
        ids = staged(near.select("id").unionByName(words.select("id")).distinct(), "candidates")
        scored = (
            ids.join(vector_scores(apart.join(ids, "id", "left_semi"), query_vector).select("id", "vector_score"), "id", "left")
            .join(matching, "id", "left")
            .select("id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("vector_score", "keyword_score")])
        )
    fused = scored.withColumn(
        "score",
        F.col("vector_score") * settings.vector_weight
        + F.col("keyword_score") * settings.keyword_weight,
    )
    best = staged(top_by(fused, "score", settings.limit(limit)), "best")
    return chunks.join(best, "id").orderBy(F.col("score").desc(), "id")
