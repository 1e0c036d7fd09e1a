"""Column lists shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

FILES = T.StructType([
    T.StructField("repo", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

CHANGES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("op", T.StringType()),
])

# What chunking yields, one row per chunk.
CHUNK_COLUMNS = [
    "id", "repo", "branch", "path", "language",
    "start_row", "start_col", "end_row", "end_col", "start_bytes", "end_bytes",
    "chunk", "signature", "chunk_kind", "heading_breadcrumb", "anchors",
    "requirement_sentences", "code_refs", "grammar_version", "eol", "overlap_bytes",
    "table_delimiter",
]

# The sixteen stored columns that make up an index row.
INDEX_COLUMNS = [
    "id", "repo", "branch", "path", "language",
    "start_row", "start_col", "end_row", "end_col", "start_bytes", "end_bytes",
    "chunk", "status", "mutation_id", "search_vector", "embedding",
]

# What a search returns besides its scores.
RESULT_COLUMNS = [
    "id", "repo", "branch", "path", "language",
    "start_row", "start_col", "end_row", "end_col", "start_bytes", "end_bytes",
    "chunk", "embedding",
]

INDEX = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("repo", T.StringType(), False),
    T.StructField("branch", T.StringType()),
    T.StructField("path", T.StringType(), False),
    T.StructField("language", T.StringType(), False),
    T.StructField("start_row", T.IntegerType(), False),
    T.StructField("start_col", T.IntegerType(), False),
    T.StructField("end_row", T.IntegerType(), False),
    T.StructField("end_col", T.IntegerType(), False),
    T.StructField("start_bytes", T.IntegerType(), False),
    T.StructField("end_bytes", T.IntegerType(), False),
    T.StructField("chunk", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("mutation_id", T.StringType()),
    T.StructField("search_vector", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType()), False),
    # Kept on top of the sixteen columns: what searches would otherwise have to
    # work out from the text again, and where a hit came from.
    T.StructField("n_words", T.IntegerType()),
    T.StructField("lexemes", T.ArrayType(T.StringType())),
    T.StructField("signature", T.StringType()),
    T.StructField("chunk_kind", T.StringType()),
    T.StructField("heading_breadcrumb", T.ArrayType(T.StringType())),
    T.StructField("anchors", T.ArrayType(T.StringType())),
    T.StructField("requirement_sentences", T.ArrayType(T.StringType())),
    T.StructField("code_refs", T.ArrayType(T.StringType())),
    T.StructField("grammar_version", T.StringType()),
    T.StructField("eol", T.StringType()),
    T.StructField("overlap_bytes", T.IntegerType()),
    T.StructField("table_delimiter", T.StringType()),
])
