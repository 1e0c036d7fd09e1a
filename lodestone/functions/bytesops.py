"""Byte-exact text positions as Column expressions.

Offsets count bytes, never characters, so ``content`` is a binary column
throughout. Every helper looks at a slice of ``content`` instead of building
a list of line positions, which keeps the work per file proportional to its
size and leaves it inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LF = "\n"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``.

    What ``use`` returns is copied, so a fold must not return all it has
    gathered so far from here, only what the step adds.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def grow(steps: Column, kind: str, more: Callable[[Column], Column], add: Callable[[Column, Column], Column]) -> Column:
    """Append ``add(last element, item)`` for each item while ``more(last element)`` holds.

    The last element is all the state there is; it is NULL in the first step.
    A fold copies what it has gathered at every step, so items are taken in
    blocks: a step copies its own block and a block copies the list of blocks.
    """
    empty = F.array().cast(f"array<{kind}>")

    def last_of(out: Column) -> Column:
        return F.get(out, F.size(out) - 1)

    def block(blocks: Column, items: Column) -> Column:
        seed = last_of(last_of(blocks))

        def step(out: Column, item: Column) -> Column:
            last = F.coalesce(last_of(out), seed)
            return F.when(more(last), F.array_append(out, add(last, item))).otherwise(out)

        # While more is wanted, a block adds one element at least.
        return F.when(
            more(seed), F.array_append(blocks, F.aggregate(items, empty, step))
        ).otherwise(blocks)

    return F.flatten(F.aggregate(blocks_of(steps), F.array().cast(f"array<array<{kind}>>"), block))


BLOCK = 128


def blocks_of(items: Column) -> Column:
    """``items`` in neighbouring blocks; none for an empty list."""
    return let(
        items,
        lambda all_: F.transform(
            F.filter(
                F.sequence(F.lit(0), F.floor(F.size(all_) / BLOCK).cast("int")),
                lambda n: n * BLOCK < F.size(all_),
            ),
            lambda n: F.slice(all_, n * BLOCK + 1, F.lit(BLOCK)),
        ),
    )


def slice_bytes(content: Column, start: Column, end: Column) -> Column:
    """``content[start:end]``; empty when ``end <= start``."""
    return F.substring(content, start + 1, F.greatest(end - start, F.lit(0)))


def slice_raw(content: Column, start: Column, end: Column) -> Column:
    """The same slice as a string whose bytes are not checked."""
    return slice_bytes(content, start, end).cast("string")


def slice_text(content: Column, start: Column, end: Column) -> Column:
    """The same slice, with bytes that are not UTF-8 replaced."""
    return F.make_valid_utf8(slice_raw(content, start, end))


def end_of_last(raw: Column, delimiter: str = LF) -> Column:
    """Bytes up to the end of the last ``delimiter``; 0 when there is none."""
    return F.octet_length(raw) - F.octet_length(F.substring_index(raw, delimiter, -1))


def start_of_first(raw: Column, delimiter: str = LF) -> Column:
    """Bytes before the first ``delimiter``; NULL when there is none."""
    before = F.octet_length(F.substring_index(raw, delimiter, 1))
    return F.nullif(before, F.octet_length(raw))


def count_lf(raw: Column) -> Column:
    return F.octet_length(raw) - F.octet_length(F.replace(raw, F.lit(LF), F.lit("")))


def _continues(content: Column, at: Column) -> Column:
    """Whether the byte at ``at`` continues a UTF-8 character."""
    return F.substring(F.hex(F.substring(content, at + 1, F.lit(1))), 1, 1).isin("8", "9", "A", "B")


def floor_char(content: Column, at: Column) -> Column:
    """Start of the character that ``at`` falls into, for valid UTF-8."""
    return (
        F.when(~F.coalesce(_continues(content, at), F.lit(False)), at)
        .when(~_continues(content, at - 1), at - 1)
        .when(~_continues(content, at - 2), at - 2)
        .otherwise(at - 3)
    )


def line_ending(content: Column) -> Column:
    """``\\r\\n`` or ``\\n`` by the first line end; empty without one."""
    return let(
        start_of_first(content.cast("string")),
        lambda first: F.when(first.isNull(), F.lit(""))
        .when(
            (first > 0) & (slice_bytes(content, first - 1, first) == F.lit(b"\r")), F.lit("\r\n")
        )
        .otherwise(F.lit("\n")),
    )


def nearest_newline(content: Column, target: Column, lo: Column, hi: Column) -> Column:
    """End of the newline closest to ``target`` among those in ``[lo, hi-1]``.

    Of two equally close newlines the earlier wins; NULL when there is none.
    """
    middle = F.least(target, hi)
    return let(
        F.struct(
            F.nullif(end_of_last(slice_raw(content, lo, middle)), F.lit(0)).alias("back"),
            start_of_first(slice_raw(content, F.greatest(lo, middle), hi)).alias("ahead"),
            lo.alias("lo"),
            F.greatest(lo, middle).alias("from"),
            target.alias("target"),
        ),
        lambda s: F.when(s["back"].isNull(), s["from"] + s["ahead"] + 1)
        .when(s["ahead"].isNull(), s["lo"] + s["back"])
        .when(
            s["target"] - (s["lo"] + s["back"] - 1) <= s["from"] + s["ahead"] - s["target"],
            s["lo"] + s["back"],
        )
        .otherwise(s["from"] + s["ahead"] + 1),
    )


def point_row(content: Column, at: Column) -> Column:
    """Zero-based line of a byte offset."""
    return count_lf(slice_raw(content, F.lit(0), at))


def point_col(content: Column, at: Column) -> Column:
    """Zero-based byte column of a byte offset."""
    return at - end_of_last(slice_raw(content, F.lit(0), at))


def running(values: Column) -> Column:
    """The sum of ``values``, longs, up to and with each of them; blocks keep the fold linear."""
    empty = F.array().cast("array<long>")

    def last_of(sums: Column) -> Column:
        return F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0).cast("long"))

    def joined(parts: Column) -> Column:
        ends = F.aggregate(parts, empty, lambda out, part: F.array_append(out, last_of(out) + last_of(part)))
        return let(ends, lambda all_: F.flatten(F.transform(parts, lambda part, i: F.transform(
            part, lambda n: n + F.when(i > 0, F.get(all_, i - 1)).otherwise(F.lit(0)),
        ))))

    sums = F.transform(blocks_of(values), lambda block: F.aggregate(
        block, empty, lambda out, n: F.array_append(out, last_of(out) + n)
    ))
    return let(sums, joined)


def newlines_in(content: Column, lo: Column, hi: Column) -> Column:
    """Offsets of all newlines in ``[lo, hi)``."""
    lengths = F.transform(
        F.split(slice_raw(content, lo, hi), LF), lambda line: (F.octet_length(line) + 1).cast("long")
    )
    ends = let(lengths, lambda n: running(F.slice(n, 1, F.greatest(F.size(n) - 1, F.lit(0)))))
    return F.transform(ends, lambda end: (lo + end - 1).cast("int"))
