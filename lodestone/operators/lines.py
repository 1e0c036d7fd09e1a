"""Blocks of files that are read line by line, as Column expressions: JSON lines, YAML and TOML.

A file is split into a table of its lines once; a fold over lengths in blocks gives
where each begins. Blocks are runs of lines between borders.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.bytesops import let, running

LINE_FAMILIES = ("jsonl", "yaml", "toml")
BLOCK = "struct<start:int,end:int,type:string,crumb:array<string>,anchors:array<string>,fence:string>"
_ENDS = r"\n\r\x0B\f\x1C-\x1E\x85  "
_LINE = rf"[^{_ENDS}]*+(?:\r\n|[{_ENDS}])|[^{_ENDS}]++"
# Line ends besides the line feed, each as it is written in a text.
_RARE_ENDS = [chr(code) for code in (0x0D, 0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029)]
_BLANK = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANK))


def split_lines(text: Column) -> Column:
    """Lines with their ends. A text with no other end than the line feed, as most are, is split there."""
    def split(own: Column) -> Column:
        fed = let(F.split(own, "\n"), lambda parts: F.transform(parts, lambda part, i: F.when(
            i < F.size(parts) - 1, F.concat(part, F.lit("\n"))
        ).otherwise(part)))
        rare = reduce(or_, [F.contains(own, F.lit(end)) for end in _RARE_ENDS])
        return F.when(rare, F.regexp_extract_all(own, F.lit(_LINE), F.lit(0))).otherwise(
            F.filter(fed, lambda line: line != ""))

    return let(text, split)


def line_table(content: Column) -> Column:
    """Each line with its first byte, its end and its text without blanks around it."""
    def placed(lines: Column) -> Column:
        ends = running(F.transform(lines, lambda line: F.octet_length(line).cast("long")))
        return F.zip_with(lines, ends, lambda line, end: F.struct(
            (end - F.octet_length(line)).cast("int").alias("start"), end.cast("int").alias("end"),
            F.startswith(line, F.lit(" ")).alias("inner"), stripped(line).alias("text"),
        ))

    return let(split_lines(content.cast("string")), placed)


def line_name(text: Column) -> Column:
    """What a line without blanks around it names: a section, a key or a list item; NULL for none."""
    mark, colon, equals = F.substring(text, 1, 1), F.instr(text, ":"), F.instr(text, "=")
    # A key ends at the first colon of the line, or, without one, at the first equals sign.
    key_end = F.when(colon > 0, colon).otherwise(equals)
    in_brackets = (mark == "[") & (F.instr(text, "]") > 0)
    item = stripped(F.substring(text, F.lit(2), F.length(text)))
    return F.when(mark.isin("", "#"), F.lit(None).cast("string")).when(
        in_brackets, stripped(F.regexp_replace(text, r"^[\[\]]+|[\[\]]+$", ""))
    ).when(key_end > 0, stripped(F.substring(text, F.lit(1), key_end - 1))).when(
        mark == "-", F.when(item == "", F.lit("-")).otherwise(item)
    )


def _block(start: Column, end: Column, kind: Column, names: Column) -> Column:
    return F.struct(
        start.alias("start"), end.alias("end"), kind.alias("type"), names.alias("crumb"),
        F.array().cast("array<string>").alias("anchors"), F.lit(None).cast("string").alias("fence"),
    ).cast(BLOCK)


def json_lines(table: Column) -> Column:
    """A block per line that is not blank, under its number."""
    numbered = F.transform(table, lambda line, i: _block(
        F.when(line["text"] != "", line["start"]), line["end"], F.lit("json"),
        F.array(F.concat(F.lit("line "), (i + 1).cast("string"))),
    ))
    return F.filter(numbered, lambda block: block["start"].isNotNull())


def sections(table: Column, family: Column) -> Column:
    """A block runs to the next line that starts flush and is no comment, and has the first name in its lines."""
    def blocks(lines: Column) -> Column:
        last = F.size(lines)
        written = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(lines, i)["text"] != "")

        def begins(i: Column) -> Column:
            line = F.get(lines, i)
            return (i == F.get(written, F.lit(0))) | (~line["inner"] & ~F.startswith(line["text"], F.lit("#")))

        def cut(starts: Column) -> Column:
            return F.transform(starts, lambda at, n: let(
                F.coalesce(F.get(starts, n + 1), last), lambda stop: _block(
                    F.get(lines, at)["start"], F.get(lines, stop - 1)["end"], family,
                    F.filter(F.slice(F.filter(
                        F.transform(F.slice(lines, at + 1, stop - at), lambda line: line_name(line["text"])),
                        lambda name: name.isNotNull(),
                    ), 1, 1), lambda name: name != ""),
                ),
            ))

        return let(F.filter(written, begins), cut)

    return let(table, blocks)


def line_blocks(content: Column, family: Column) -> Column:
    """Blocks of a file of ``LINE_FAMILIES``; NULL for others."""
    return let(F.when(family.isin(*LINE_FAMILIES), content), lambda own: F.when(
        family == "jsonl", json_lines(line_table(own))
    ).when(family.isin(*LINE_FAMILIES), sections(line_table(own), family)))
