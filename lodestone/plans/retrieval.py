"""From a search line to the best chunks, and how they are shown."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone import config as C
from lodestone.functions.text import file_tag, markdown_block
from lodestone.operators.embed import Loader, embed_query, HashingModel
from lodestone.operators.fusion import search_rrf
from lodestone.operators.rerank import Reranker, rerank

Search = Callable[..., DataFrame]


def retrieve(
    chunks: DataFrame,
    query: str,
    *,
    top_k: int = C.DEFAULT_TOP_K,
    repo: str | None = None,
    branch: str | None = None,
    query_vector: Sequence[float] | None = None,
    model: Loader | None = None,
    dim: int = C.EMBEDDING_DIM,
    reranker: Reranker | None = None,
    initial_limit: int = C.DEFAULT_INITIAL_LIMIT,
    max_initial_limit: int = C.MAX_INITIAL_LIMIT,
    search: Search = search_rrf,
) -> DataFrame:
    """The ``top_k`` best chunks; none for a blank query.

    The reranker sees ``initial_limit`` candidates, at most ``max_initial_limit``.
    """
    text = (query or "").strip()
    if not text:
        return chunks.where(F.lit(False)).withColumn("score", F.lit(0.0))
    if query_vector is None:
        query_vector = embed_query(text, model or HashingModel(dim), dim=dim)
    found = search(
        chunks, query_vector, text, C.first_stage_limit(top_k, initial_limit, max_initial_limit),
        repo=repo, branch=branch,
    )
    if reranker is None:
        return found.orderBy(F.col("score").desc(), "id").limit(top_k)
    return rerank(found, text, top_k, reranker)


def as_chunks(rows: DataFrame) -> DataFrame:
    """Hits with the defaults a chunk has where the index holds nothing."""
    zero = ["start_row", "start_col", "end_row", "end_col", "start_bytes"]
    text = F.coalesce("chunk", F.lit(""))
    return rows.withColumns({
        "chunk": text,
        "repo": F.coalesce("repo", F.lit("")),
        "path": F.coalesce("path", F.lit("")),
        "language": F.coalesce(F.nullif("language", F.lit("")), F.lit("unknown")),
        **{c: F.coalesce(c, F.lit(0)) for c in zero},
        "end_bytes": F.coalesce(F.nullif(F.col("end_bytes"), F.lit(0)), F.octet_length(text)),
    })


def formatted(hits: DataFrame) -> DataFrame:
    """Hits without their vectors, each with its ``<file>`` element."""
    return hits.drop("embedding").withColumn(
        "formatted", file_tag(F.col("path"), F.col("repo"), F.col("branch"), F.col("chunk"))
    )


def markdown(hits: DataFrame, order: str = "score") -> DataFrame:
    """All hits of one search as a single Markdown text, best first."""
    block = markdown_block(F.col("path"), F.col("language"), F.col("chunk"))
    listed = F.array_sort(
        F.collect_list(F.struct((-F.col(order)).alias("rank"), F.col("id"), block.alias("block")))
    )
    return hits.agg(
        F.array_join(F.transform(listed, lambda x: x["block"]), "\n\n").alias("markdown")
    )


def search_code(
    chunks: DataFrame, query: str, top_k: int = 5, repo: str | None = None,
    branch: str | None = None, **options,
) -> dict:
    """The search tool: its hits as plain values and one Markdown text."""
    rank = "score" if options.get("reranker") is None else "rerank_score"
    hits = as_chunks(retrieve(chunks, query, top_k=top_k, repo=repo, branch=branch, **options))
    # At most top_k rows.
    rows = formatted(hits).orderBy(F.col(rank).desc(), "id").collect()
    blocks = [f"### {r['path']}\n\n```{r['language']}\n{r['chunk']}\n```" for r in rows]
    results = [{**r.asDict(), "embeddings": None} for r in rows]
    return {"results": results, "markdown": "\n\n".join(blocks)}
