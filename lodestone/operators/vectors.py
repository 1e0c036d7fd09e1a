"""Exact vector search."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.vector import cosine_to, unit
from lodestone.operators.keyword import in_scope, top_by


def vector_scores(
    chunks: DataFrame, query: Sequence[float], *, repo: str | None = None, branch: str | None = None
) -> DataFrame:
    """Every row in scope with its cosine to the query as ``vector_score``."""
    rows = in_scope(chunks, repo, branch)
    return rows.withColumn("vector_score", cosine_to(rows["embedding"], unit(query)))


def vector_search(
    chunks: DataFrame,
    query: Sequence[float],
    limit: int,
    *,
    repo: str | None = None,
    branch: str | None = None,
) -> DataFrame:
    return top_by(vector_scores(chunks, query, repo=repo, branch=branch), "vector_score", limit)


# Rows of an Arrow batch, and queries, that are compared as one matrix product.
QUERY_BLOCK = 1024
_PACKED = "ids array<string>, width int, data binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every batch of ``id, embedding`` as one row per width; rows without a usable vector score nothing."""
    for batch in batches:
        groups: dict[int, list] = {}
        ids, vectors = batch.column("id").to_pylist(), batch.column("embedding")
        for at, key in enumerate(ids):
            if vectors[at].is_valid and len(vectors[at]):
                vector = vectors[at].values.to_numpy(zero_copy_only=False).astype(np.float64)
                length = np.linalg.norm(vector)
                if np.isfinite(length) and length > 0:
                    groups.setdefault(len(vector), []).append((key, vector / length))
        if groups:
            yield pa.RecordBatch.from_pydict({
                "ids": [[k for k, _ in rows] for rows in groups.values()],
                "width": pa.array(list(groups), pa.int32()),
                "data": [np.stack([v for _, v in rows]).tobytes() for rows in groups.values()],
            })


def _block_tops(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    # One pair of blocks at a time, its numbers where the batch holds them: a batch is not copied.
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        for at in range(batch.num_rows):
            width = columns["width"][at].as_py()
            if width != columns["query_width"][at].as_py():
                continue
            left, right = (
                np.frombuffer(columns[c][at].as_buffer()).reshape(-1, width) for c in ("query_data", "data"))
            scores, ids = left @ right.T, np.array(columns["ids"][at].as_py())
            found = [np.lexsort((ids, -line))[:limit] for line in scores]
            queries = columns["query_ids"][at].as_py()
            yield pa.RecordBatch.from_pydict({
                "query_id": [q for q, best in zip(queries, found, strict=True) for _ in best],
                "id": [str(ids[i]) for best in found for i in best],
                "vector_score": [float(scores[n, i]) for n, best in enumerate(found) for i in best],
            })


def vector_search_many(rows: DataFrame, queries: DataFrame, limit: int) -> DataFrame:
    """``query_id, id, vector_score``: the ``limit`` nearest ``rows`` of every row of ``queries``.

    Both have ``id, embedding``. Rows and queries are packed into blocks, and a
    pair of blocks is one matrix product of which the best rows per query remain;
    those are merged per query, cut to the limit before they are shuffled.
    Queries of another width than a row's do not meet it.
    """
    blocks = rows.select("id", "embedding").mapInArrow(_packed, _PACKED)
    asked = queries.select("id", "embedding").repartition(
        max(1, -(-queries.count() // QUERY_BLOCK))
    ).mapInArrow(_packed, _PACKED).toDF("query_ids", "query_width", "query_data")
    # Every block of rows meets every block of queries; a join by width would put all in one task.
    tops = blocks.crossJoin(asked).mapInArrow(
        partial(_block_tops, limit=limit), "query_id string, id string, vector_score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("vector_score").desc(), "id")
    return tops.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= limit).drop("_place")
