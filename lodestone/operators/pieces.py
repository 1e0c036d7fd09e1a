"""Pieces of a file: spans with their place, their text and what is known of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.bytesops import count_lf, end_of_last, grow, let, line_ending, slice_raw

# What a piece carries besides its span. Documents fill the first five fields,
# source and markup files the last three.
TAG = (
    "struct<types:array<string>,fences:array<string>,crumb:array<string>,"
    "anchors:array<string>,described:string,kind:string,signature:string,text:string>"
)
PIECE = (
    "struct<start:int,end:int,start_row:int,start_col:int,end_row:int,end_col:int,"
    f"chunk:string,tag:{TAG}>"
)


def strings(*items: Column) -> Column:
    return F.array(*items).cast("array<string>")


def document_tag(
    types: Column, fences: Column, crumb: Column, anchors: Column, described: Column
) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(types, fences, crumb, anchors, described, nothing, nothing, nothing).cast(TAG)


def unit_tag(kind: Column, signature: Column, text: Column) -> Column:
    empty = strings()
    return F.struct(
        empty, empty, empty, empty, F.lit(None).cast("string"), kind, signature, text
    ).cast(TAG)


def place_spans(content: Column, spans: Column) -> Column:
    """Add line and column of both ends and the text to ``spans``.

    Lines are counted from the start of one span to the start of the next, so
    every byte is read a bounded number of times whatever the size of the file.
    ``spans`` holds ``start``, ``end`` and ``tag``.
    """

    def locate(raw: Column, base: Column, row: Column, last: Column) -> Column:
        return let(
            end_of_last(raw),
            lambda e: F.struct(
                (row + count_lf(raw)).alias("row"),
                F.when(e > 0, base + e - 1).otherwise(last).alias("last"),
            ),
        )

    def placed(span: Column, at: Column, body: Column) -> Column:
        return let(
            locate(body, span["start"], at["row"], at["last"]),
            lambda to: F.struct(
                span["start"].alias("start"),
                span["end"].alias("end"),
                at["row"].alias("start_row"),
                (span["start"] - at["last"] - 1).alias("start_col"),
                to["row"].alias("end_row"),
                (span["end"] - to["last"] - 1).alias("end_col"),
                F.make_valid_utf8(body).alias("chunk"),
                span["tag"].alias("tag"),
            ).cast(PIECE),
        )

    def add(before: Column, span: Column) -> Column:
        pos = F.coalesce(before["start"], F.lit(0))
        row = F.coalesce(before["start_row"], F.lit(0))
        last = F.coalesce(before["start"] - before["start_col"] - 1, F.lit(-1))
        return let(
            let(slice_raw(content, pos, span["start"]), lambda gap: locate(gap, pos, row, last)),
            lambda at: let(
                slice_raw(content, span["start"], span["end"]),
                lambda body: placed(span, at, body),
            ),
        )

    return grow(F.sort_array(spans), PIECE, lambda _: F.lit(True), add)


def with_line_ending(content: Column, pieces: Column) -> Column:
    """Put the line ending on every piece, so the file need not outlive its pieces."""
    return let(
        line_ending(content),
        lambda eol: F.transform(pieces, lambda p: p.withField("eol", eol)),
    )
