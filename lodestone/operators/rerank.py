"""Scoring a short list of candidates against the query once more."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone import config as C
from lodestone.functions.analysis import fold_text, words
from lodestone.operators.embed import loaded

# From a query and the text of the candidates to one score each.
Scorer = Callable[[str, Sequence[str]], Sequence[float]]
Reranker = Callable[[str, Column], Column]


def lexical_reranker(query: str, text: Column) -> Column:
    """Shared distinct words over all distinct words, inside the JVM."""
    import re

    wanted = sorted(set(re.findall(r"[^\W_]+", fold_text(query))))
    asked = F.array(*map(F.lit, wanted)).cast("array<string>")
    own = F.array_distinct(words(text))
    shared = F.size(F.array_intersect(own, asked))
    union = F.size(own) + len(wanted) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def model_reranker(loader: Callable[[], Scorer], batch: int = C.RERANK_BATCH) -> Reranker:
    """A model that scores pairs, loaded once per Python worker."""

    def rerank(query: str, text: Column) -> Column:
        @F.arrow_udf(T.DoubleType())
        def score(texts: pa.Array) -> pa.Array:
            model, found = loaded(loader), texts.to_pylist()
            out: list[float] = []
            for at in range(0, len(found), batch):
                group = found[at:at + batch]
                scores = [float(s) for s in np.asarray(model(query, group)).reshape(-1)]
                if len(scores) != len(group):
                    raise ValueError(f"reranker gave {len(scores)} scores for {len(group)} candidates")
                out += scores
            return pa.array(out, pa.float64())

        return score(text)

    return rerank


def rerank(candidates: DataFrame, query: str, top_k: int, reranker: Reranker) -> DataFrame:
    """The best ``top_k`` candidates; equal scores keep the order of ``score``."""
    return (
        candidates.withColumn("rerank_score", reranker(query, F.col("chunk")))
        .orderBy(F.col("rerank_score").desc(), F.col("score").desc(), F.col("id"))
        .limit(top_k)
    )
