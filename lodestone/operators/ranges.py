"""Cutting byte spans into pieces of bounded size.

Each function is a fold over one file's own spans, so a file never leaves its
row and no shuffle is needed however many files there are. Folds run over
``sequence(1, bound)``; the bounds are proven where they are computed, and a
finished fold passes its state on unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone import config as C
from lodestone.functions.bytesops import (
    blocks_of,
    end_of_last,
    floor_char,
    grow,
    let,
    nearest_newline,
    slice_raw,
    start_of_first,
)

PIECE = "struct<start:int,end:int>"
SPAN = f"array<{PIECE}>"


def _int(value) -> Column:
    return F.lit(value).cast("int")


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))


def no_spans() -> Column:
    return F.array().cast(SPAN)


def _next_cut(content: Column, cur: Column, end: Column) -> Column:
    """End of the piece that starts at ``cur``.

    The first line end past the soft size wins, then the last line end before
    it, and a line longer than the hard size is cut at a character.
    """
    soft, hard = C.DOC_SOFT_BYTES, C.DOC_HARD_BYTES
    stop = F.least(cur + hard, end)
    return let(
        F.struct(
            cur.alias("cur"),
            stop.alias("stop"),
            start_of_first(slice_raw(content, cur + (soft - 1), stop)).alias("late"),
        ),
        lambda s: F.when(s["late"].isNotNull(), s["cur"] + soft + s["late"])
        .when(s["stop"] == end, end)
        .otherwise(
            let(
                end_of_last(slice_raw(content, s["cur"], s["cur"] + (soft - 1))),
                lambda early: F.when(early > 0, s["cur"] + early).otherwise(
                    floor_char(content, s["stop"])
                ),
            )
        ),
    ).cast("int")


def split_span(content: Column, start: Column, end: Column) -> Column:
    """Cut ``[start, end)`` at line ends into pieces of 2048 to 4096 bytes.

    A piece shorter than 2047 bytes is followed by a line that runs past the
    hard size, so any two neighbours cover more than 2047 bytes together and
    the number of pieces is below ``2 * size / 2047 + 2``.
    """
    size = end - start
    bound = (F.floor(size / (C.DOC_SOFT_BYTES - 4)) * 2 + 3).cast("int")

    def cur(last: Column) -> Column:
        return F.coalesce(last["end"], start.cast("int"))

    cuts = grow(
        F.sequence(_int(1), bound),
        PIECE,
        lambda last: cur(last) < end,
        lambda last, _: let(
            cur(last), lambda at: _span(at, _next_cut(content, at, end))
        ),
    )
    return F.when(size <= C.DOC_HARD_BYTES, F.array(_span(start, end))).otherwise(cuts)


def newline_ranges(
    content: Column,
    start: Column,
    end: Column,
    soft: int = C.CODE_SOFT_BYTES,
    hard: int = C.CODE_HARD_BYTES,
    overlap: int = 0,
) -> Column:
    """Cut ``[start, end)`` near every ``soft`` bytes, at the closest newline.

    A cut that moves less than ``soft / 2`` has no newline within ``soft / 2``
    past its target. It can be met again once, when the overlap steps back over
    it, and the step after that moves at least ``soft / 2``. Three steps
    therefore move on by ``soft / 2 - overlap`` or more, with four at the end.
    """
    stride = soft // 2 - overlap
    bound = (F.floor((end - start) / stride) * 3 + 7).cast("int")

    def cur(last: Column) -> Column:
        return (
            F.when(last.isNull(), start.cast("int"))
            .when((last["end"] >= end) | (last["end"] - overlap <= last["start"]), last["end"])
            .otherwise(last["end"] - overlap)
        )

    def cut(at: Column) -> Column:
        target = F.least(at + soft, end)
        found = nearest_newline(
            content,
            target,
            F.greatest(at + 1, target - C.NEWLINE_REACH),
            F.least(end - 1, target + C.NEWLINE_REACH),
        )
        return F.least(F.coalesce(found, target), at + hard)

    ranges = grow(
        F.sequence(_int(1), bound),
        PIECE,
        lambda last: last.isNull() | (last["end"] < end),
        lambda last, _: let(cur(last), lambda at: _span(at, cut(at))),
    )
    return F.when(start >= end, no_spans()).otherwise(ranges)


def plain_ranges(content: Column) -> Column:
    """Ranges of a whole file without any structure to go by."""
    return newline_ranges(
        content, F.lit(0), F.octet_length(content), overlap=C.CODE_OVERLAP_BYTES
    )


def cover(content: Column, groups: Column) -> Column:
    """Fill the gaps before, between and after ``groups`` so all bytes appear.

    ``groups`` are sorted spans that do not overlap. Gaps are cut like any
    other text, so a gap of one newline becomes a piece of its own.
    """
    total = F.octet_length(content)
    with_gap = F.transform(
        groups,
        lambda g, i: F.concat(
            newline_ranges(
                content,
                F.when(i == 0, F.lit(0)).otherwise(F.get(groups, i - 1)["end"]),
                g["start"],
            ),
            F.array(_span(g["start"], g["end"])),
        ),
    )
    tail = newline_ranges(content, F.element_at(groups, -1)["end"], total)
    return F.concat(F.flatten(with_gap), tail)


def limit_spans(content: Column, spans: Column, hard: int = C.CODE_HARD_BYTES) -> Column:
    """Cut the spans longer than ``hard`` and keep the others."""
    return F.flatten(
        F.transform(
            spans,
            lambda s: F.when(
                s["end"] - s["start"] > hard, newline_ranges(content, s["start"], s["end"])
            ).otherwise(F.array(_span(s["start"], s["end"]))),
        )
    )


def _joined(left: Column, right: Column) -> Column:
    """``left`` grown to the end of ``right``; the head of the group stays."""
    return left.withField("end", right["end"]).withField(
        "types", F.array_union(left["types"], right["types"])
    ).withField("fences", F.array_union(left["fences"], right["fences"]))


def _fold_groups(segments: Column, kind: str, joins) -> Column:
    """Join neighbouring segments while ``joins(group, next)`` holds."""
    one = F.array().cast(f"array<{kind}>")
    many = F.array().cast(f"array<array<{kind}>>")

    def step(acc: Column, seg: Column) -> Column:
        return F.when(
            joins(acc["open"], seg),
            F.struct(acc["done"].alias("done"), _joined(acc["open"], seg).alias("open")),
        ).otherwise(
            F.struct(F.array_append(acc["done"], acc["open"]).alias("done"), seg.alias("open"))
        )

    def block(acc: Column, items: Column) -> Column:
        return let(
            F.aggregate(items, F.struct(one.alias("done"), acc["open"].alias("open")), step),
            lambda b: F.struct(
                F.array_append(acc["done"], b["done"]).alias("done"), b["open"].alias("open")
            ),
        )

    folded = F.aggregate(
        blocks_of(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0)))),
        F.struct(many.alias("done"), F.get(segments, F.lit(0)).alias("open")),
        block,
        lambda acc: F.array_append(F.flatten(acc["done"]), acc["open"]),
    )
    return F.when(F.size(segments) <= 1, segments).otherwise(folded)


def pack_segments(segments: Column, kind: str) -> Column:
    """Fill segments up to the soft document size."""
    return _fold_groups(
        segments, kind, lambda open_, seg: seg["end"] - open_["start"] <= C.DOC_SOFT_BYTES
    )


def merge_small(segments: Column, kind: str) -> Column:
    """Join every segment below 512 bytes, except the first, to the one before."""
    return _fold_groups(
        segments, kind, lambda _, seg: seg["end"] - seg["start"] < C.DOC_MIN_BYTES
    )
