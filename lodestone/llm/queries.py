"""The operators of this folder as jobs over the sample tables, and their SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import (
    bpe, chat, exact_dedup, html_text, importance, minhash, mixing, pii, quality, token_counts, toxicity,
    vector_dedup, whitening,
)
from lodestone.llm.common import held_out, table
from lodestone.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(job):
        QUERIES[job.__name__] = lambda spark, folder: job(configure(spark), folder)
        if sql:
            SQL[job.__name__] = sql
        return job

    return register


@query()
def op1_html(spark, folder):
    """The main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


@query(minhash.SQL)
def op2_minhash(spark, folder):
    """The near-copy component of every document."""
    return minhash.near_groups(table(spark, folder, "documents"))


@query()
def op3_bpe(spark, folder):
    """Token counts and digests of every text."""
    return bpe.digests(bpe.encode_decode(table(spark, folder, "documents")))


@query(vector_dedup.SQL)
def op4_vector_dedup(spark, folder):
    """The links and the component of every vector."""
    return vector_dedup.vector_groups(table(spark, folder, "embeddings"))


@query()
def op5_toxicity(spark, folder):
    """Toxicity of every document by two language models."""
    docs = table(spark, folder, "documents")
    apart = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, table(spark, folder, "labels"), ~apart)
    return toxicity.scored(docs, model).select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op6_token_counts(spark, folder):
    """Tokens of every document before and after three edits, and what was encoded for each."""
    state = token_counts.counted(table(spark, folder, "documents"))
    size = F.length("text")
    edits = F.array(*[
        F.struct(F.floor(start).cast("int").alias("start"), F.floor(stop).cast("int").alias("stop"), text.alias("text"))
        for start, stop, text in (
            (size / 2, size / 2 + 10, F.lit("")), (F.lit(0), F.lit(0), F.lit("Edited: ")),
            (size * 3 / 4, size * 3 / 4, F.substring("text", 1, 20)),
        )
    ])
    return token_counts.edited(state, edits).select(
        "doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_edited"),
        F.length("text").cast("long").alias("n_chars_edited"), F.col("n_encoded").alias("n_chars_encoded"),
    )


@query()
def op7_quality(spark, folder):
    """Quality of every document by preference pairs."""
    docs = table(spark, folder, "documents")
    apart = held_out(F.col("doc_id"), 4, 2)
    model = quality.train(docs, table(spark, folder, "labels"), ~apart)
    return quality.scored(docs, model).select(
        "doc_id", apart.alias("held_out"), "score",
        (F.col("score") >= quality.CUT_SCORE).cast("int").alias("predicted"),
    )


@query()
def op8_pii(spark, folder):
    """Spans of personal data in every document."""
    return pii.span_digests(table(spark, folder, "documents"))


@query(mixing.SQL)
def op9_mix_sources(spark, folder):
    """How many words the mix takes of every document."""
    return mixing.mixed_sizes(table(spark, folder, "documents"))


@query(r"""
WITH own AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
picked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM own)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM picked
""")
def op10_exact_dedup(spark, folder):
    """The group of equal texts of every document."""
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query(chat.SQL)
def op11_chat_format(spark, folder):
    """What is read back from every formatted conversation and its loss mask."""
    return chat.digests(chat.formatted(chat.with_hostile(table(spark, folder, "conversations"))))


@query()
def op12_importance(spark, folder):
    """Weight, score and rank of every document towards the benchmark's texts."""
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op13_whitening(spark, folder):
    """Every vector on the leading components of all vectors, whitened."""
    return whitening.whitened(table(spark, folder, "embeddings"))
