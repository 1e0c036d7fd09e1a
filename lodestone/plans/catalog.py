"""Named jobs over the sample tables: each operator on whole tables and whole texts.

Text with paragraphs, code marks or keys is derived from ``documents`` by one
expression per row, so the work grows with the table and no rows are grouped
only to make up a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone import config as C
from lodestone.functions import bytesops as B
from lodestone.functions import text as X
from lodestone.functions import vector as V
from lodestone.functions.analysis import lexemes, words
from lodestone.operators import keyword as K
from lodestone.operators import ranges as R
from lodestone.operators.chunk import chunk_files, chunk_plaintext, whole_blocks
from lodestone.operators.dispatch import dispatch
from lodestone.operators.document import SEGMENT, cut_blocks, group_segments
from lodestone.operators.embed import error_reports, HashingModel, with_embeddings
from lodestone.operators.fusion import rrf, search_rrf, search_weighted
from lodestone.operators.lines import line_blocks
from lodestone.operators.rerank import lexical_reranker
from lodestone.operators.structure import structure_blocks
from lodestone.operators.vectors import vector_scores, vector_search, vector_search_many
from lodestone.plans.batch_retrieval import retrieve_many
from lodestone.plans.checkpoint import file_system, shared_folder, staged
from lodestone.plans.indexing import index_changes, metrics, not_yet_indexed, split_changes
from lodestone.plans.retrieval import formatted, markdown, retrieve
from lodestone.sources.files import files_from_table, is_binary, is_ignored
from lodestone.sources.index_table import (
    IndexTable,
    indexed_paths,
    latest,
    upserted,
    without_orphans,
    without_paths,
)
from lodestone.sources.postings_store import PostingsStore
from lodestone.sources.registry import StoreConfig
from lodestone.sources.vector_index import VectorIndex
from lodestone.streaming.delta import merge_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Search lines and the vector searched with.
WORDS = "the onanshat blely"
PHRASE = "of_the lyin"
SUBSTRING = "ndthe"
WEB_QUERY = '"of the" lyin -blely or shor onanshat'
VECTOR = [((i * 37) % 64 - 31.5) / 64 for i in range(64)]


def query(job: Query) -> Query:
    QUERIES[job.__name__] = job
    return job


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(spark: SparkSession, rows: DataFrame, key: str) -> DataFrame:
    """Rows as they are read, unless the session asks for them to be dealt out.

    ``lodestone.spread`` is for tables of one row group, which one task reads.
    """
    partitions = int(spark.conf.get("lodestone.spread", "0"))
    return rows.repartition(partitions, key) if partitions else rows


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(spark, table(spark, folder, "documents"), "doc_id")


def document_files(
    spark: SparkSession, folder: str, content: Column | None = None, suffix: str = "txt"
) -> DataFrame:
    """``documents`` as files: source is the repository and language the branch."""
    return files_from_table(
        documents(spark, folder),
        repo=F.col("source"),
        branch=F.col("lang"),
        path=F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("." + suffix)),
        content=F.col("text") if content is None else content,
    )


def doc_key(column: str = "doc_id") -> Column:
    return F.lpad(F.col(column).cast("string"), 12, "0")


_INDEX_ROW = [
    "lpad(doc_id, 12, '0') AS id", "source AS repo", "lang AS branch",
    "'doc_' || doc_id || '.txt' AS path", "'text' AS language", "text AS chunk",
]


def document_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as index rows without vectors."""
    return documents(spark, folder).selectExpr(*_INDEX_ROW)


def document_index(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as index rows, with a vector where ``embeddings`` has one."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return (
        documents(spark, folder)
        .join(vectors, "doc_id", "left")
        .selectExpr(*_INDEX_ROW, "embedding")
    )


def document_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``id, repo, branch, embedding`` of all documents, without their texts."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    rows = table(spark, folder, "documents").select("doc_id", "source", "lang")
    return rows.join(vectors, "doc_id", "left").selectExpr(*_INDEX_ROW[:3], "embedding")


def op_log(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as a log of file changes, one path per user."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit(".txt")).alias("path"),
        F.when(kind.isin("signup", "view"), "A").when(kind.isin("click", "purchase"), "M").otherwise("D").alias("op"),
        "ts", "event_id",
    )


def latest_ops(spark: SparkSession, folder: str) -> DataFrame:
    return latest(op_log(spark, folder), ["path"], [F.col("ts"), F.col("event_id")])


# --- files and changes ------------------------------------------------------


@query
def files_projection(spark, folder):
    return document_files(spark, folder).select(
        "repo", "branch", "path", F.octet_length("content").alias("n_bytes")
    )


@query
def changes_latest(spark, folder):
    return latest_ops(spark, folder).select("path", "op", "event_id")


@query
def changes_split_counts(spark, folder):
    wanted, deleted = split_changes(latest_ops(spark, folder), ignore="user_1*.txt; !user_12*.txt")
    return (
        wanted.withColumn("side", F.lit("process"))
        .unionByName(deleted.withColumn("side", F.lit("delete")))
        .groupBy("side")
        .agg(F.count("*").alias("n"))
    )


IGNORE = "src1*/**/doc_*7.txt, /src3/; !src3/en/**, fr/, *.lock, doc_1[0-4]?.txt"


@query
def ignore_filter(spark, folder):
    path = F.concat_ws("/", "source", "lang", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    rows = table(spark, folder, "documents").select(path.alias("path"))
    return rows.where(~is_ignored(F.col("path"), IGNORE))


@query
def binary_filter(spark, folder):
    marked = F.replace(F.col("text"), F.lit(" the "), F.lit("\x01" * 12))
    rows = table(spark, folder, "documents").select("doc_id", marked.cast("binary").alias("content"))
    return rows.select("doc_id", is_binary(F.col("content")).alias("binary"))


@query
def readable_prefix(spark, folder):
    """Whether each text, followed by the first half of its bytes, is UTF-8."""
    half = F.floor(F.octet_length("text") / 2).cast("int")
    content = F.col("text").cast("binary")
    both = F.concat(content, F.substring(content, F.lit(1), half))
    return table(spark, folder, "documents").select(
        "doc_id", F.is_valid_utf8(both.cast("string")).alias("readable")
    )


@query
def resume_antijoin(spark, folder):
    done = table(spark, folder, "labels").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path")
    )
    return not_yet_indexed(document_files(spark, folder).select("path"), done)


EXTENSIONS = ["py", "MD", "json", "ndjson", "yml", "toml", "csv", "tsv", "lock", "html", "h", "xyz", ""]


@query
def dispatch_family(spark, folder):
    files = table(spark, folder, "documents").select(
        F.concat(
            F.lit("dir.d/doc_"), F.col("doc_id").cast("string"),
            F.when(F.col("doc_id") % 13 == 12, "").otherwise("."),
            F.element_at(F.array(*map(F.lit, EXTENSIONS)), (F.col("doc_id") % 13 + 1).cast("int")),
        ).alias("path"),
        F.col("text").cast("binary").alias("content"),
    )
    return dispatch(files).groupBy("family", "language").agg(F.count("*").alias("n"))


# --- chunking ---------------------------------------------------------------


def spans(files: DataFrame, build, *columns: str) -> DataFrame:
    """Explode the spans that ``build`` makes of each file's content."""
    return files.select(
        "path", F.explode(B.let(F.col("content"), build)).alias("s")
    ).select("path", *[F.col(f"s.{c}").alias(f"{c}_bytes") for c in ("start", "end")], *columns)


@query
def plaintext_parts(spark, folder):
    return spans(
        document_files(spark, folder), lambda c: R.split_span(c, F.lit(0), F.octet_length(c))
    )


@query
def plaintext_segments(spark, folder):
    text = F.lit("text")
    return spans(
        document_files(spark, folder),
        lambda c: group_segments(cut_blocks(c, whole_blocks(c, text)), text),
    )


CHUNK_REPORT = [
    "id", "path", "language", "start_row", "start_col", "end_row", "end_col", "start_bytes",
    "end_bytes", "chunk_kind", "eol",
]


@query
def plaintext_chunks(spark, folder):
    return chunk_plaintext(document_files(spark, folder)).select(*CHUNK_REPORT)


@query
def plaintext_chunk_text(spark, folder):
    return chunk_plaintext(document_files(spark, folder)).select(
        "path", "start_bytes", "end_bytes", F.md5("chunk").alias("chunk_md5"), "signature"
    )


@query
def csv_chunks(spark, folder):
    files = document_files(spark, folder, F.replace("text", F.lit(" "), F.lit(",")), "csv")
    return chunk_plaintext(files).select(*CHUNK_REPORT, "table_delimiter", "overlap_bytes")


@query
def jsonl_chunks(spark, folder):
    content = F.concat(
        F.lit('{"t":"'), F.replace("text", F.lit("\n"), F.lit('"}\n{"t":"')), F.lit('"}')
    )
    return chunk_files(document_files(spark, folder, content, "jsonl")).select(
        "path", "language", "start_bytes", "end_bytes", "chunk_kind",
        F.array_join("heading_breadcrumb", "/").alias("crumb"),
    )


@query
def json_members(spark, folder):
    """Spans of the members of one JSON object per part."""
    content = F.concat(
        F.lit('{"name": "'), F.col("p_name"), F.lit('",\n "size": '), F.col("p_size").cast("string"),
        F.lit(',\n "tags": ["'), F.col("p_brand"), F.lit('", "'), F.col("p_type"), F.lit('"]}\n'),
    )
    rows = table(spark, folder, "part").select("p_partkey", content.cast("binary").alias("content"))
    found = rows.select(
        "p_partkey", F.explode(structure_blocks(F.lit("json"), F.col("content"))).alias("b")
    )
    return found.select(
        "p_partkey", F.col("b.start").alias("start_bytes"), F.col("b.end").alias("end_bytes"),
        F.array_join("b.crumb", "/").alias("crumb"),
    )


def sectioned(text: Column) -> Column:
    """Flush lines become keys, sentences become list items below them."""
    keyed = F.regexp_replace(text, r"(^|\n)([^ \n]+)", "$1$2:")
    return F.replace(keyed, F.lit(". "), F.lit(".\n  - "))


@query
def yaml_blocks(spark, folder):
    files = document_files(spark, folder, sectioned(F.col("text")), "yaml")
    found = files.select(
        "path", F.explode(line_blocks(F.col("content"), F.lit("yaml"))).alias("b")
    )
    return found.select(
        "path", F.col("b.start").alias("start_bytes"), F.col("b.end").alias("end_bytes"),
        F.array_join("b.crumb", "/").alias("heading"),
    )


@query
def yaml_chunks(spark, folder):
    files = document_files(spark, folder, sectioned(F.col("text")), "yaml")
    return chunk_files(files).select(
        "path", "language", "chunk_kind", "start_bytes", "end_bytes", "start_row", "end_row",
        F.array_join("heading_breadcrumb", "/").alias("crumb"),
    )


@query
def toml_chunks(spark, folder):
    content = F.regexp_replace("text", r"(^|\n)([^ \n]+)", "$1[$2]\nkey =")
    return chunk_files(document_files(spark, folder, content, "toml")).select(
        *CHUNK_REPORT, F.array_join("heading_breadcrumb", "/").alias("crumb")
    )


@query
def markdown_chunks(spark, folder):
    content = F.regexp_replace("text", r"(^|\n)([^ \n]+) ?", "$1\n## $2\n\n")
    return chunk_files(document_files(spark, folder, content, "md")).select(
        *CHUNK_REPORT, F.array_join("heading_breadcrumb", "/").alias("crumb"),
        F.array_join("anchors", "/").alias("anchors"),
    )


@query
def markdown_headings(spark, folder):
    """Heading blocks with their slugs, one for every line of text."""
    content = F.regexp_replace("text", r"(^|\n)([^ \n]+) ?", "$1\n## $2\n\n")
    files = document_files(spark, folder, content, "md")
    found = files.select(
        "path", F.explode(structure_blocks(F.lit("markdown"), F.col("content"))).alias("b")
    ).where("b.type = 'heading'")
    return found.select(
        "path", F.col("b.start").alias("start_bytes"), F.col("b.end").alias("end_bytes"),
        F.array_join("b.crumb", "/").alias("crumb"),
    )


@query
def html_chunks(spark, folder):
    pages = spread(spark, table(spark, folder, "pages"), "page_id")
    files = files_from_table(
        pages, repo=F.lit("web"), content=F.col("html"),
        path=F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")),
    )
    return chunk_files(files).select(*CHUNK_REPORT)


@query
def code_chunks(spark, folder):
    """Every text as source code with one method per line; cut near line ends."""
    content = F.concat(
        F.lit("package corpus;\nclass Doc {\n  int n = 0;\n  void run() {\n    say(\""),
        F.replace(F.replace("text", F.lit('"'), F.lit("'")), F.lit("\n"), F.lit("\");\n  }\n  void run() {\n    say(\"")),
        F.lit("\");\n  }\n}\n"),
    )
    return chunk_files(document_files(spark, folder, content, "java")).select(*CHUNK_REPORT, "signature")


def byte_ranges(soft: int, hard: int, overlap: int):
    return lambda c: R.newline_ranges(c, F.lit(0), F.octet_length(c), soft, hard, overlap)


@query
def size_ranges_code(spark, folder):
    return spans(
        document_files(spark, folder),
        byte_ranges(C.CODE_SOFT_BYTES, C.CODE_HARD_BYTES, C.CODE_OVERLAP_BYTES),
    )


@query
def size_ranges_bytes(spark, folder):
    return spans(
        document_files(spark, folder),
        byte_ranges(C.DOC_SOFT_BYTES, C.DOC_HARD_BYTES, C.DOC_OVERLAP_BYTES),
    )


@query
def nearest_newlines(spark, folder):
    """Newline closest to every 1024th byte of every text."""
    size = F.octet_length("content")
    targets = F.when(size > C.CODE_SOFT_BYTES, F.sequence(
        F.lit(C.CODE_SOFT_BYTES), size - 1, F.lit(C.CODE_SOFT_BYTES)
    ))
    found = F.transform(targets, lambda at: F.struct(at.alias("target"), B.nearest_newline(
        F.col("content"), at, F.greatest(F.lit(1), at - C.NEWLINE_REACH),
        F.least(size - 1, at + C.NEWLINE_REACH),
    ).cast("int").alias("after")))
    return document_files(spark, folder).select("path", F.inline(found))


@query
def middle_points(spark, folder):
    middle = F.floor(F.octet_length("content") / 2).cast("int")
    return document_files(spark, folder).select(
        "path",
        B.point_row(F.col("content"), middle).alias("row"),
        B.point_col(F.col("content"), middle).alias("col"),
        F.size(B.newlines_in(F.col("content"), F.lit(0), middle)).alias("newlines"),
    )


# --- text functions ---------------------------------------------------------


def marked() -> Column:
    """Text with requirement words and inline code put in."""
    return F.replace(
        F.replace("text", F.lit(" the "), F.lit(" must ")), F.lit(" and "), F.lit(" `and` ` of the`")
    )


@query
def requirement_sentences(spark, folder):
    found = documents(spark, folder).select(
        "doc_id", F.posexplode(X.requirement_sentences(marked())).alias("pos", "sentence")
    )
    return found.select("doc_id", "pos", "sentence")


@query
def code_refs(spark, folder):
    fences = F.when(F.col("doc_id") % 2 == 0, F.array(F.col("lang"))).otherwise(F.array().cast("array<string>"))
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(X.code_refs(marked(), fences), "|").alias("refs")
    )


@query
def slugify_titles(spark, folder):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, folder, "pages").select("page_id", X.slugify(title).alias("slug"))


@query
def document_signatures(spark, folder):
    text = F.col("text")
    crumb = F.when(F.col("doc_id") % 3 == 0, F.array("lang", "source")).otherwise(F.array().cast("array<string>"))
    return table(spark, folder, "documents").select(
        "doc_id",
        X.document_signature(
            F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(F.lit("")),
            F.concat(F.lit("doc_"), F.col("doc_id").cast("string")),
            F.lit(0), F.octet_length(text), crumb, text,
        ).alias("signature"),
    )


@query
def line_endings(spark, folder):
    text = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", B.line_ending(text.cast("binary")).alias("eol")
    )


@query
def chunk_kinds(spark, folder):
    """Kind of every document from made-up block types and its own sentences."""
    types = F.array(F.lit("paragraph"), F.when(F.col("doc_id") % 5 == 0, "fence").otherwise("list"))
    rows = table(spark, folder, "documents").select(
        "doc_id", X.chunk_kind(types, X.requirement_sentences(marked())).alias("kind")
    )
    return rows


@query
def chunk_ids(spark, folder):
    branch = F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    return table(spark, folder, "documents").select(
        "doc_id",
        X.chunk_id(
            F.col("source"), branch, F.concat(F.lit("doc_"), F.col("doc_id").cast("string")),
            F.lit(0), F.octet_length("text"),
        ).alias("id"),
    )


@query
def section_headings(spark, folder):
    """The name of every block of every text, behind a comment and a section or an item."""
    text = F.concat(F.lit(" # note\n"), F.when(F.col("doc_id") % 2 == 0, F.lit(" [ a.b ]\n")).otherwise(F.lit("\n - ")), F.col("text"))
    rows = documents(spark, folder).select("doc_id", line_blocks(text.cast("binary"), F.lit("toml")).alias("blocks"))
    found = rows.select("doc_id", F.posexplode("blocks").alias("block", "b"))
    return found.select("doc_id", "block", F.array_join("b.crumb", "/").alias("heading"))


# --- vectors ----------------------------------------------------------------


def vector_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        doc_key("vec_id").alias("id"), F.concat(F.lit("label_"), F.col("label").cast("string")).alias("repo"),
        F.lit("main").alias("branch"), "embedding",
    )


def rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column), digits).alias(column)


@query
def vector_topk(spark, folder):
    found = vector_search(vector_rows(spark, folder), VECTOR, 50)
    return found.select("id", rounded("vector_score"))


@query
def vector_topk_many(spark, folder):
    """The ten nearest vectors of every fiftieth one, searched in one job."""
    rows = vector_rows(spark, folder)
    found = vector_search_many(rows, rows.where(F.col("id").cast("long") % 50 == 0), 10)
    return found.select("query_id", "id", rounded("vector_score"))


@query
def vector_filtered(spark, folder):
    found = vector_search(vector_rows(spark, folder), VECTOR, 20, repo="label_3", branch="main")
    return found.select("id", "repo", rounded("vector_score"))


@query
def vector_mismatch_zero(spark, folder):
    """Cosine of all rows, where some vectors are too short, zero or missing."""
    key = F.col("id").cast("int")
    rows = vector_rows(spark, folder).withColumn(
        "embedding",
        F.when(key % 5 == 0, F.slice("embedding", 1, 32))
        .when(key % 5 == 1, F.transform("embedding", lambda x: F.lit(0.0).cast("float")))
        .when(key % 5 == 2, F.lit(None).cast("array<float>"))
        .otherwise(F.col("embedding")),
    )
    return vector_scores(rows, VECTOR).select("id", rounded("vector_score"))


@query
def cosine_expression(spark, folder):
    """Cosine of every vector with its own reverse, as a Column expression."""
    return vector_rows(spark, folder).select(
        "id", F.round(V.cosine(F.col("embedding"), F.reverse("embedding")), 6).alias("score")
    )


@query
def vector_bytes(spark, folder):
    """Vectors through their byte form and back."""
    raw = V.to_bytes(F.col("embedding"))
    rows = vector_rows(spark, folder).select("id", raw.alias("raw"))
    back = V.from_bytes(F.col("raw"))
    return rows.select(
        "id", F.octet_length("raw").alias("n_bytes"),
        F.round(F.aggregate(back, F.lit(0.0), lambda s, x: s + x.cast("double")), 6).alias("total"),
    )


# --- stored searches --------------------------------------------------------


def stored(spark: SparkSession, folder: str, name: str, kind, fill):
    """A store filled from a table once per application, and again when the table's files change."""
    files, at = file_system(spark, f"{folder}/{name}.parquet")
    state = f"{files.getFileStatus(at).getModificationTime()} {files.getContentSummary(at).getLength()}"
    key = uuid.uuid5(uuid.NAMESPACE_URL, f"{spark.sparkContext.applicationId} {folder} {name} {kind.__name__} {state}").hex
    place = f"{shared_folder(spark)}/store-{key}"
    found = kind(spark, place)
    if not found.segments.log():
        fill(found)
        files, at = file_system(spark, place)
        files.deleteOnExit(at)
    return found


def stored_words(spark: SparkSession, folder: str) -> PostingsStore:
    return stored(spark, folder, "documents", PostingsStore, lambda store: store.commit(document_texts(spark, folder)))


def stored_vectors(spark: SparkSession, folder: str) -> VectorIndex:
    rows = vector_rows(spark, folder).select("id", "embedding")
    return stored(spark, folder, "embeddings", VectorIndex, lambda index: index.build(rows))


@query
def vector_topk_ann(spark, folder):
    """Ten neighbours of every fiftieth vector by the inverted file, held against the exact scan."""
    rows = vector_rows(spark, folder).select("id", "embedding")
    asked = rows.where(F.col("id").cast("long") % 50 == 0)
    near = staged(stored_vectors(spark, folder).search_many(asked, 10), "near")
    exact = vector_search_many(rows, asked, 10)
    hit = near.select("query_id", "id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "id"], "left").agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("neighbours"),
        (F.sum(F.coalesce("hit", F.lit(0))) >= 0.95 * F.count("*")).alias("recall_reached"),
    )


@query
def stored_postings_search(spark, folder):
    """The best chunks by stored postings, with ranges passed over that cannot reach them."""
    found = stored_words(spark, folder).top(WORDS, 50).rows
    return found.select("id", rounded("keyword_score"))


@query
def postings_after_changes(spark, folder):
    """Scores after a build of all texts, three deltas and a compaction in between."""
    rows = document_texts(spark, folder)
    store = PostingsStore(spark, f"{shared_folder(spark)}/changed-{uuid.uuid4().hex}")
    store.commit(rows)
    key = F.col("id").cast("long")
    for step in range(3):
        changed = rows.where(key % 7 == step).withColumn("chunk", F.concat("chunk", F.lit(" the lyin" * (step + 1))))
        store.commit(changed, rows.where(key % 11 == step).where(key % 7 != step).select("id"))
        if step == 1:
            store.compact()
    found = staged(store.scores(WORDS).select("id", rounded("keyword_score")), "scores")
    store.drop()
    return found


@query
def retrieve_many_titles(spark, folder):
    """The first three words of every fiftieth text, with its vector, as search lines of one job."""
    line = F.array_join(F.slice(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), 1, 3), " ")
    asked = table(spark, folder, "documents").where("doc_id % 50 = 0").select("doc_id", line.alias("query"))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    lines = asked.join(vectors, "doc_id").select(doc_key().alias("query_id"), "query", "embedding")
    found = retrieve_many(
        document_texts(spark, folder), lines, stored_words(spark, folder), vectors=document_vectors(spark, folder)
    )
    return found.select("query_id", "id", "place", rounded("score"))


# --- keyword search ---------------------------------------------------------


@query
def fts_terms(spark, folder):
    """Document frequency and count of every word."""
    rows = K.postings(document_texts(spark, folder))
    return rows.groupBy("term").agg(
        F.count("*").alias("df"), F.sum(F.col("tf").cast("long")).alias("cf")
    )


@query
def bm25_topk(spark, folder):
    found = K.top_by(K.bm25_scores(document_texts(spark, folder), WORDS), "keyword_score", 50)
    return found.select("id", rounded("keyword_score"))


@query
def bm25_filtered(spark, folder):
    found = K.bm25_scores(document_texts(spark, folder), WORDS, repo="src8", branch="en")
    return found.select("id", "repo", "branch", rounded("keyword_score"))


@query
def bm25_postings(spark, folder):
    """Every chunk that holds a word of the query, by stored postings."""
    found = stored_words(spark, folder).scores(WORDS)
    return found.select("id", rounded("keyword_score"))


@query
def phrase_match(spark, folder):
    found = K.bm25_scores(document_texts(spark, folder), PHRASE)
    return found.select("id", rounded("keyword_score"))


@query
def phrase_postings(spark, folder):
    found = stored_words(spark, folder).scores(PHRASE)
    return found.select("id", rounded("keyword_score"))


@query
def like_match(spark, folder):
    return K.like(document_texts(spark, folder), "E_hat%The").select("id", "keyword_score")


@query
def keyword_fallback(spark, folder):
    """A part of words is no word, so the search turns to substrings."""
    return K.keyword_search(document_texts(spark, folder), SUBSTRING, 50).select("id", "keyword_score")


def with_lexemes(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "lexemes", F.regexp_extract_all(F.lower("chunk"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    )


@query
def text_match_web(spark, folder):
    wanted = K.web_query('"of the" lyin or shor -onanshat', english=False)
    rows = with_lexemes(document_texts(spark, folder))
    return rows.where(K.text_matches(F.col("lexemes"), wanted)).select("id")


@query
def cover_density(spark, folder):
    """Nearness of the words of a phrase and a word, or of two words, without texts of another word."""
    wanted = K.web_query(WEB_QUERY, english=False)
    rows = with_lexemes(document_texts(spark, folder)).where(K.text_matches(F.col("lexemes"), wanted))
    return rows.select("id", F.round(K.cover_rank(F.col("lexemes"), wanted), 6).alias("rank"))


@query
def english_lexemes(spark, folder):
    """How often each English stem occurs, in texts of all languages."""
    rows = table(spark, folder, "documents")
    found = rows.select(F.explode(lexemes(F.col("text"))).alias("lexeme")).where("lexeme <> ''")
    return found.groupBy("lexeme").agg(F.count("*").alias("n"))


# --- fusion and retrieval ---------------------------------------------------

SCORES = ["keyword_score", "vector_score", "score"]


@query
def hybrid_rrf(spark, folder):
    found = search_rrf(document_texts(spark, folder), VECTOR, WORDS, 40, vectors=document_vectors(spark, folder))
    return found.select("id", "keyword_rank", "vector_rank", *map(rounded, SCORES))


@query
def hybrid_rrf_filtered(spark, folder):
    found = search_rrf(
        document_texts(spark, folder), VECTOR, WORDS, 4, branch="en", vectors=document_vectors(spark, folder)
    )
    return found.select("id", "branch", "keyword_rank", "vector_rank", *map(rounded, SCORES))


@query
def rrf_word_candidates(spark, folder):
    """Rank fusion of the hundred best keyword hits with the hundred best vector hits."""
    words_ = K.bm25_scores(document_texts(spark, folder), "onanshat lyin").select("id", "repo", "keyword_score")
    near = vector_scores(document_vectors(spark, folder), VECTOR).where("vector_score <> 0").select("id", "repo", "vector_score")
    found = rrf(K.top_by(words_, "keyword_score", 100), K.top_by(near, "vector_score", 100), 200)
    return found.select("id", "repo", "keyword_rank", "vector_rank", rounded("score"))


@query
def hybrid_weighted(spark, folder):
    found = search_weighted(
        with_lexemes(document_texts(spark, folder)), VECTOR, WEB_QUERY, 20, english=False,
        vectors=document_vectors(spark, folder),
    )
    return found.select("id", *map(rounded, SCORES))


@query
def hybrid_empty_query(spark, folder):
    found = search_weighted(
        document_texts(spark, folder), VECTOR, "  ", 20, vectors=document_vectors(spark, folder)
    )
    return found.select("id", rounded("vector_score"), rounded("keyword_score"))


def apart(spark: SparkSession, folder: str):
    """Hybrid search with the vectors in a table of their own."""
    return partial(search_rrf, vectors=document_vectors(spark, folder))


@query
def retrieve_topk(spark, folder):
    found = retrieve(document_texts(spark, folder), f" {WORDS} ", top_k=10, query_vector=VECTOR, search=apart(spark, folder))
    return found.select("id", "path", rounded("score"))


@query
def rerank_lexical(spark, folder):
    found = retrieve(
        document_texts(spark, folder), WORDS, top_k=10, query_vector=VECTOR, reranker=lexical_reranker,
        search=apart(spark, folder),
    )
    return found.select("id", rounded("rerank_score"))


@query
def render_results(spark, folder):
    rows = document_texts(spark, folder).withColumn(
        "chunk", F.concat(F.lit("if x < y & \"z\" > 'w': "), F.col("chunk"))
    )
    return formatted(rows).select("id", F.md5("formatted").alias("formatted_md5"))


@query
def render_markdown(spark, folder):
    found = retrieve(document_texts(spark, folder), WORDS, top_k=5, query_vector=VECTOR, search=apart(spark, folder))
    return markdown(found)


@query
def passage_search(spark, folder):
    """Chunks of all documents, searched by words and by the vector of their document."""
    vectors = table(spark, folder, "embeddings").select(
        F.concat(F.lit("doc_"), F.col("vec_id").cast("string"), F.lit(".txt")).alias("path"), "embedding"
    )
    chunks = staged(chunk_plaintext(document_files(spark, folder)).select(
        "id", "repo", "branch", "path", "start_bytes", "end_bytes", "chunk"
    ), "chunks")
    near = chunks.select("id", "repo", "branch", "path").join(vectors, "path", "left")
    found = search_rrf(chunks, VECTOR, WORDS, 20, vectors=near)
    return found.select("id", "path", "start_bytes", "end_bytes", rounded("score"))


@query
def passage_hashed_search(spark, folder):
    """The same search with hashed vectors of the chunks themselves."""
    chunks = with_embeddings(chunk_plaintext(document_files(spark, folder)), HashingModel(256), dim=256)
    found = retrieve(chunks, WORDS, top_k=10, model=HashingModel(256), dim=256)
    return found.select("id", "path", "start_bytes", rounded("score"))


# --- embedding --------------------------------------------------------------


def failing_model():
    """A model that fails on every batch with the marker."""
    inner = HashingModel(64)

    def embed(texts):
        if any("onanshat" in t for t in texts):
            raise ValueError("marker found")
        return inner.embed(texts)

    return embed


def embedded_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = document_texts(spark, folder)
    placed = rows.withColumns({
        "start_row": F.lit(0), "start_col": F.lit(0), "end_row": F.lit(0), "end_col": F.lit(0),
        "signature": F.col("path"),
    })
    return with_embeddings(placed, failing_model, dim=64, batch=1)


@query
def embedding_errors(spark, folder):
    return error_reports(embedded_documents(spark, folder)).select("path", "message", "signature")


@query
def index_metrics(spark, folder):
    deleted = latest_ops(spark, folder).where("op = 'D'").select("path")
    return metrics(embedded_documents(spark, folder), deleted)


# --- stored indexes -----------------------------------------------------------

DIM = 32


@dataclass(frozen=True)
class MarkedFails:
    """A model that fails on texts with a mark."""

    mark: str
    dim: int = DIM

    def __call__(self):
        def embed(texts):
            if any(self.mark in t for t in texts):
                raise ValueError("marked")
            return HashingModel(self.dim).embed(texts)

        return embed


def new_index(spark: SparkSession) -> IndexTable:
    return IndexTable(spark, StoreConfig(table=f"chunks_{uuid.uuid4().hex}"), buckets=4)


def index_files(spark: SparkSession, folder: str, text: Column, branch: str = "main") -> DataFrame:
    return document_files(spark, folder, text).withColumns(
        {"repo": F.lit("docs"), "branch": F.lit(branch)}
    )


def every(files: DataFrame, op: str) -> DataFrame:
    return files.select("path", F.lit(op).alias("op"))


def indexed_bytes(index: IndexTable) -> DataFrame:
    """Where the last chunk of each stored file ends; the index is deleted."""
    found = staged(index.read().groupBy("branch", "path").agg(F.max("end_bytes").alias("n_bytes")), "indexed")
    index.drop()
    return found


@query
def index_two_branches(spark, folder):
    """Every text on two branches, the longer version indexed last; both stay."""
    index = new_index(spark)
    for branch, text in (("main", F.col("text")), ("dev", F.concat("text", F.lit(" more")))):
        files = index_files(spark, folder, text, branch)
        index_changes(index, files, every(files, "M"), repo="docs", model=HashingModel(DIM), dim=DIM)
    return indexed_bytes(index)


@query
def index_failed_model(spark, folder):
    """A second version of every text, of which a third cannot be embedded and keeps the first."""
    index = new_index(spark)
    first = index_files(spark, folder, F.col("text"))
    index_changes(index, first, every(first, "A"), repo="docs", model=HashingModel(DIM), dim=DIM)
    end = F.when(F.col("doc_id") % 3 == 0, F.lit(" %REFUSED%")).otherwise(F.lit(" accepted!"))
    second = index_files(spark, folder, F.concat("text", end))
    index_changes(
        index, second, every(second, "M"), repo="docs", model=MarkedFails("%REFUSED%"), dim=DIM, batch=1
    )
    return indexed_bytes(index)


@query
def index_merge_state(spark, folder):
    """An index of all texts after the last change of every path in the event log."""
    index = new_index(spark)
    first = index_files(spark, folder, F.col("text"))
    index_changes(index, first, every(first, "A"), repo="docs", model=HashingModel(DIM), dim=DIM)
    changes = latest_ops(spark, folder).select(
        F.replace("path", F.lit("user_"), F.lit("doc_")).alias("path"), "op"
    )
    second = index_files(spark, folder, F.concat("text", F.lit("!")))
    index_changes(index, second, changes, repo="docs", model=HashingModel(DIM), dim=DIM)
    return indexed_bytes(index)


@query
def stream_late_changes(spark, folder):
    """The event log as changes in three batches that each hold early and late ones, and one batch twice."""
    index = new_index(spark)
    log = op_log(spark, folder).select(
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + F.col("event_id") % 1000).alias("seq"), "op",
        F.replace("path", F.lit("user_"), F.lit("doc_")).alias("path"), "event_id",
    )
    docs = table(spark, folder, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "text")
    changes = staged(log.join(docs, "path").select(
        "seq", F.lit("main").alias("branch"), "path", "op", (F.col("event_id") % 3).alias("part"),
        F.when(F.col("op") != "D", F.concat("text", F.lit(" at "), F.col("seq").cast("string"))).cast("binary").alias("content"),
    ), "log")
    for part in (2, 0, 2, 1):
        merge_batch(index, changes.where(F.col("part") == part).drop("part"), repo="docs", model=HashingModel(DIM), dim=DIM)
    return indexed_bytes(index)


@query
def chunk_coverage(spark, folder):
    """Bytes of every text, as source code and as plain text, that are in no chunk."""
    files = document_files(spark, folder).unionByName(document_files(spark, folder, suffix="java"))
    file = Window.partitionBy("path").orderBy("start_bytes", "end_bytes")
    before = F.max("end_bytes").over(file.rowsBetween(Window.unboundedPreceding, -1))
    rows = chunk_files(files).select("path", "start_bytes", "end_bytes", (
        F.greatest(F.col("start_bytes") - F.coalesce(before, F.lit(0)), F.lit(0))
    ).alias("gap"))
    return rows.groupBy("path").agg(F.max("end_bytes").alias("n_bytes"), F.sum("gap").alias("missing"))


@query
def structured_coverage(spark, folder):
    """Bytes of every text, in each structured family and in broken JSON, that are in no chunk and not blank."""
    text = F.col("text")
    forms = {
        "json": F.to_json(F.struct(text.alias("body"), F.split(text, "\n").alias("lines"))),
        "broken.json": F.concat(F.lit('{"first": 1, second: two, "third": '), text, F.lit('\n "last": [1, 2}')),
        "two.json": F.concat(F.to_json(F.struct(text.alias("one"))), F.lit(" and\n"), F.to_json(F.array(text))),
        "jsonl": text, "yaml": sectioned(text), "toml": text, "md": text, "csv": text,
    }
    files = [document_files(spark, folder, form, suffix) for suffix, form in forms.items()]
    files = reduce(DataFrame.unionByName, files).where("octet_length(content) > 0")
    spans = staged(chunk_files(files).select("path", "start_bytes", "end_bytes"), "spans")
    ends = files.select("path", F.octet_length("content").alias("start_bytes"), F.octet_length("content").alias("end_bytes"))
    file = Window.partitionBy("path").orderBy("start_bytes", "end_bytes").rowsBetween(Window.unboundedPreceding, -1)
    gaps = spans.unionByName(ends).withColumn("before", F.coalesce(F.max("end_bytes").over(file), F.lit(0)))
    gaps = staged(gaps.where("before < start_bytes").select("path", "before", "start_bytes"), "gaps")
    left = files.join(gaps, "path").select("path", F.octet_length(F.regexp_replace(
        B.slice_text(F.col("content"), F.col("before"), F.col("start_bytes")), r"\s", ""
    )).cast("long").alias("n"))
    every_path = spans.select("path").distinct()
    return every_path.join(left, "path", "left").groupBy("path").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("missing"))


# --- index maintenance ------------------------------------------------------


@query
def upsert_latest(spark, folder):
    """The last of several writes of one id."""
    rows = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("seq"), "role", F.md5("text").alias("body")
    )
    return latest(rows, ["id"], [F.col("seq")])


@query
def upsert_merge(spark, folder):
    """Documents, with those that have a label written anew."""
    existing = table(spark, folder, "documents").select(
        doc_key().alias("id"), F.col("source").alias("repo"), F.col("lang").alias("status")
    )
    incoming = table(spark, folder, "labels").select(
        doc_key().alias("id"), F.lit("labelled").alias("repo"),
        F.concat_ws("-", F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("status"),
    )
    return upserted(existing, incoming)


@query
def delete_paths(spark, folder):
    gone = table(spark, folder, "labels").where("quality = 0").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path")
    )
    rows = document_texts(spark, folder).select("id", "repo", "branch", "path")
    kept = without_paths(rows.where("repo <> 'src2'"), gone)
    return kept.unionByName(without_paths(rows.where("repo = 'src2'"), gone, repo="src3"))


@query
def purge_orphans(spark, folder):
    index = K.postings(document_texts(spark, folder)).select("term", "id", "tf")
    alive = table(spark, folder, "labels").select(doc_key().alias("id"))
    return without_orphans(index, alive).groupBy("id").agg(
        F.count("*").alias("terms"), F.sum(F.col("tf").cast("long")).alias("words")
    )


@query
def indexed_path_set(spark, folder):
    log = op_log(spark, folder).select(
        F.when(F.col("op") != "D", F.col("path")).alias("path"), F.col("op").alias("repo")
    )
    return indexed_paths(log, repo="M")


@query
def changed_chunks(spark, folder):
    """Chunks of the paths whose last change is no deletion."""
    last = latest_ops(spark, folder).select(
        F.regexp_replace("path", "user_", "doc_").alias("path"), "op"
    )
    wanted, _ = split_changes(last)
    files = document_files(spark, folder).join(wanted, "path", "left_semi")
    return chunk_plaintext(files).select("path", "start_bytes", "end_bytes")
