"""Files in, chunk rows out: a narrow job without any shuffle."""

from __future__ import annotations

from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.bytesops import let
from lodestone.functions.text import chunk_id
from lodestone.operators.dispatch import dispatch
from lodestone.operators.document import byte_spans, describe, document_spans, whole_block
from lodestone.operators.lines import line_blocks
from lodestone.operators.pieces import place_spans, unit_tag, with_line_ending
from lodestone.operators.ranges import plain_ranges
from lodestone.operators.structure import structure_blocks
from lodestone.schema import CHUNK_COLUMNS


def with_ids(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn(
        "id", chunk_id(*[F.col(c) for c in ("repo", "branch", "path", "start_bytes", "end_bytes")])
    ).select(*CHUNK_COLUMNS)


def whole_blocks(content: Column, family: Column) -> Column:
    """Text, CSV and TSV are one block."""
    return whole_block(
        content, F.when(family.isin("csv", "tsv"), F.lit("table")).otherwise(F.lit("text"))
    )


def document_blocks(files: DataFrame) -> DataFrame:
    """Add ``blocks`` and settle family and language of what is structured.

    A structured file without any block is treated as plain text.
    """
    content, family = F.col("content"), F.col("family")
    found = files.withColumn(
        "blocks", F.coalesce(
            line_blocks(content, family), structure_blocks(family, F.when(family.isin("markdown", "json"), content))
        )
    )
    empty = F.size("blocks") == 0
    return found.withColumns({
        "language": F.when(empty, F.lit("text")).otherwise(F.col("language")),
        "family": F.when(empty, F.lit("text")).otherwise(family),
        "blocks": F.when(F.col("blocks").isNull() | empty, whole_blocks(content, family)).otherwise(
            F.col("blocks")
        ),
    })


def _tagged(ranges: Column) -> Column:
    tag = unit_tag(F.lit("text"), F.lit(""), F.lit(None).cast("string"))
    return F.transform(
        ranges,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), tag.alias("tag")),
    )


def _pieces(spans) -> Column:
    """Placed pieces of a file; its content is bound once for all steps.

    An empty file has none. It is told apart here rather than by a filter,
    which would compute a derived content a second time.
    """
    return let(
        F.col("content"),
        lambda content: F.when(
            F.octet_length(content) > 0,
            let(
                spans(content),
                lambda found: with_line_ending(content, place_spans(content, found)),
            ),
        ),
    )


def _exploded(files: DataFrame, pieces: Column) -> DataFrame:
    language = F.when(F.col("family") == "bytes", F.lit("text")).otherwise(F.col("language"))
    rows = files.select(
        "repo", "branch", "path", language.alias("language"), "family",
        F.explode(pieces).alias("piece"),
    )
    return with_ids(describe(rows))


# The expressions below have thousands of nodes and name columns only, so they
# are built once per Spark context rather than once per job.


@cache
def _plain_pieces(_: SparkContext) -> Column:
    family = F.col("family")
    return _pieces(
        lambda content: F.when(family == "bytes", byte_spans(content)).otherwise(
            document_spans(content, F.col("blocks"), family)
        )
    )


@cache
def _any_pieces(_: SparkContext) -> Column:
    family = F.col("family")

    def spans(content: Column) -> Column:
        return (
            F.when(family == "bytes", byte_spans(content))
            .when(family.isin("code", "markup"), _tagged(plain_ranges(content)))
            .otherwise(document_spans(content, F.col("blocks"), family))
        )

    return _pieces(spans)


def chunk_plaintext(files: DataFrame) -> DataFrame:
    """Chunks of files known to be plain text or tables; runs in the JVM only."""
    known = dispatch(files)
    return _exploded(
        known.withColumn("blocks", whole_blocks(F.col("content"), F.col("family"))),
        _plain_pieces(files.sparkSession.sparkContext),
    )


def chunk_files(files: DataFrame) -> DataFrame:
    """Chunks of any files.

    All files pass once. The function that looks at structure gets the content
    of Markdown and JSON only, so all other files never go to Python. Source and markup files are cut near line ends with an
    overlap; every byte of a file is in some chunk.
    """
    scanned = document_blocks(dispatch(files))
    return _exploded(scanned, _any_pieces(files.sparkSession.sparkContext))
