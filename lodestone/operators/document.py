"""From blocks of a document to chunk rows: cut, merge, overlap, locate, describe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import config as C
from lodestone.functions import text as X
from lodestone.functions.bytesops import end_of_last, floor_char, let, slice_raw
from lodestone.operators.pieces import document_tag, strings
from lodestone.operators.ranges import merge_small, newline_ranges, pack_segments, split_span

SEGMENT = (
    "struct<start:int,end:int,head:string,types:array<string>,fences:array<string>,"
    "crumb:array<string>,anchors:array<string>>"
)

def whole_block(content: Column, kind: Column) -> Column:
    """The one block of a text without inner structure."""
    return F.array(
        F.struct(
            F.lit(0).alias("start"), F.octet_length(content).alias("end"), kind.alias("type"),
            strings().alias("crumb"), strings().alias("anchors"),
            F.lit(None).cast("string").alias("fence"),
        )
    )


def _segment(span: Column, block: Column) -> Column:
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        block["type"].alias("head"),
        strings(block["type"]).alias("types"),
        F.when(block["fence"].isNotNull(), strings(block["fence"])).otherwise(strings()).alias("fences"),
        block["crumb"].alias("crumb"),
        block["anchors"].alias("anchors"),
    ).cast(SEGMENT)


def cut_blocks(content: Column, blocks: Column) -> Column:
    """Bounded parts of all blocks; headings stay whole."""

    def parts(block: Column) -> Column:
        spans = F.when(
            block["type"] == "heading",
            F.array(F.struct(block["start"].alias("start"), block["end"].alias("end"))),
        ).otherwise(split_span(content, block["start"], block["end"]))
        return F.transform(spans, lambda span: _segment(span, block))

    return F.flatten(F.transform(blocks, parts))


def group_segments(parts: Column, family: Column) -> Column:
    packed = let(
        parts,
        lambda p: F.when(family == "markdown", pack_segments(p, SEGMENT)).otherwise(p),
    )
    return let(packed, lambda p: merge_small(p, SEGMENT))


def overlap_start(content: Column, prev_end: Column) -> Column:
    """Where a chunk that follows ``prev_end`` begins, so it repeats some context.

    The last paragraph break within reach, else the last newline, else a fixed
    number of bytes. The break that ends the previous chunk does not count.
    """
    lo = F.greatest(F.lit(0), prev_end - C.PARAGRAPH_REACH)
    raw = slice_raw(content, lo, F.greatest(lo, prev_end - 2))

    def choose(s: Column) -> Column:
        return (
            F.when((s["lf"] > 0) & ((s["crlf"] == 0) | (s["lf"] - 2 > s["crlf"] - 4)), s["lo"] + s["lf"])
            .when(s["crlf"] > 0, s["lo"] + s["crlf"])
            .when(s["nl"] > 0, s["lo"] + s["nl"])
            .otherwise(F.greatest(F.lit(0), prev_end - C.DOC_OVERLAP_BYTES))
        )

    return let(
        raw,
        lambda w: let(
            F.struct(
                lo.alias("lo"),
                end_of_last(w, "\n\n").alias("lf"),
                end_of_last(w, "\r\n\r\n").alias("crlf"),
                end_of_last(w).alias("nl"),
            ),
            choose,
        ),
    )


def with_overlap(content: Column, segments: Column) -> Column:
    """Spans with their overlap; ``tag`` keeps the segment and the text that describes it."""

    def place(seg: Column, i: Column) -> Column:
        follows = (i > 0) & (seg["head"] != "heading")
        start = F.when(
            follows, F.least(seg["start"], overlap_start(content, F.get(segments, i - 1)["end"]))
        ).otherwise(seg["start"])
        return let(
            start,
            lambda s: F.struct(
                s.cast("int").alias("start"),
                seg["end"].alias("end"),
                document_tag(
                    seg["types"], seg["fences"], seg["crumb"], seg["anchors"],
                    let(
                        floor_char(content, s),
                        lambda at: F.when(at < s, slice_raw(content, at, seg["end"])),
                    ),
                ).alias("tag"),
            ),
        )

    return F.transform(segments, place)


def document_spans(content: Column, blocks: Column, family: Column) -> Column:
    """Spans of all chunks of one document."""
    return let(
        group_segments(cut_blocks(content, blocks), family),
        lambda segments: with_overlap(content, segments),
    )


def byte_spans(content: Column) -> Column:
    """Spans of all chunks of a document that is not UTF-8."""
    tag = document_tag(
        strings(F.lit("text")), strings(), strings(), strings(), F.lit(None).cast("string")
    )
    ranges = newline_ranges(
        content, F.lit(0), F.octet_length(content),
        C.DOC_SOFT_BYTES, C.DOC_HARD_BYTES, C.DOC_OVERLAP_BYTES,
    )
    return F.transform(
        ranges,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), tag.alias("tag")),
    )


def describe(rows: DataFrame) -> DataFrame:
    """Columns of a chunk from an exploded ``piece``.

    Source and markup pieces bring kind, signature and, for a type summary,
    their text. Documents get theirs from the text they cover.
    """
    piece, tag = F.col("piece"), F.col("piece.tag")
    document = tag["kind"].isNull()
    none = F.array().cast("array<string>")
    requirements = F.col("requirement_sentences")
    kind = F.when(
        F.col("family") == "bytes", F.when(F.size(requirements) > 0, "req").otherwise("text")
    ).otherwise(X.chunk_kind(tag["types"], requirements))
    return (
        rows.withColumn("described", F.when(document, F.coalesce(tag["described"], piece["chunk"])))
        .withColumn(
            "requirement_sentences", F.coalesce(X.requirement_sentences(F.col("described")), none)
        )
        .select(
            "repo", "branch", "path", "language",
            *[piece[name].alias(name) for name in ("start_row", "start_col", "end_row", "end_col")],
            piece["start"].alias("start_bytes"),
            piece["end"].alias("end_bytes"),
            F.coalesce(tag["text"], piece["chunk"]).alias("chunk"),
            F.when(
                document,
                X.document_signature(
                    F.col("repo"), F.col("path"), piece["start"], piece["end"],
                    tag["crumb"], F.col("described"),
                ),
            )
            .otherwise(tag["signature"])
            .alias("signature"),
            F.when(document, kind).otherwise(tag["kind"]).alias("chunk_kind"),
            tag["crumb"].alias("heading_breadcrumb"),
            tag["anchors"].alias("anchors"),
            "requirement_sentences",
            F.when(document, X.code_refs(F.col("described"), tag["fences"]))
            .otherwise(none)
            .alias("code_refs"),
            F.when(document, F.lit(C.DOC_VERSION)).alias("grammar_version"),
            F.when(document, piece["eol"]).alias("eol"),
            F.when(document, F.lit(C.DOC_OVERLAP_BYTES)).alias("overlap_bytes"),
            F.when(F.col("family") == "csv", ",")
            .when(F.col("family") == "tsv", "\t")
            .alias("table_delimiter"),
        )
    )
