"""Files as rows of ``repo, branch, path, content``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def files_from_table(
    table: DataFrame, *, repo: Column, path: Column, content: Column, branch: Column | None = None
) -> DataFrame:
    """Any table with a text or binary column, seen as files."""
    return table.select(
        repo.cast("string").alias("repo"),
        (F.lit(None) if branch is None else branch).cast("string").alias("branch"),
        path.cast("string").alias("path"),
        content.cast("binary").alias("content"),
    )


def files_from_directory(
    spark: SparkSession, root: str, *, repo: str, branch: str | None = None
) -> DataFrame:
    """Every file below ``root``; paths are relative to it."""
    base = root.rstrip("/")
    read = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    )
    tail = F.concat(F.lit("/"), F.lit(base.split("://")[-1].strip("/")), F.lit("/"))
    at = F.instr(F.col("path"), tail)
    return read.select(
        F.lit(repo).alias("repo"),
        F.lit(branch).cast("string").alias("branch"),
        F.substring(F.col("path"), at + F.length(tail), F.length("path")).alias("path"),
        "content",
    )


def _glob_regex(glob: str) -> str:
    """A gitignore-style pattern as a regular expression over a whole path."""
    anchored = "/" in glob.rstrip("/")
    body = glob.strip("/")
    out, at = "", 0
    while at < len(body):
        rest = body[at:]
        if rest.startswith("**/"):
            out, at = out + "(?:[^/]+/)*", at + 3
        elif rest == "**":
            out, at = out + ".*", at + 2
        elif rest[0] == "*":
            out, at = out + "[^/]*", at + 1
        elif rest[0] == "?":
            out, at = out + "[^/]", at + 1
        elif rest[0] == "[" and "]" in rest[2:]:
            stop = rest.index("]", 2)
            inner = rest[1:stop].replace("\\", "\\\\")
            out, at = out + "[" + re.sub("^!", "^", inner) + "]", at + stop + 1
        elif rest[0] == "\\" and len(rest) > 1:
            out, at = out + re.escape(rest[1]), at + 2
        else:
            out, at = out + re.escape(rest[0]), at + 1
    head = "^" if anchored else "^(?:.*/)?"
    # A directory pattern only covers what lies inside the directory.
    return head + out + ("/.*$" if glob.endswith("/") else "(?:/.*)?$")


def ignore_patterns(setting: str) -> list[str]:
    return [p.strip() for p in setting.replace(";", ",").split(",") if p.strip()]


def is_ignored(path: Column, setting: str) -> Column:
    """Whether the last pattern that covers ``path`` excludes it."""
    ignored = F.lit(False)
    for pattern in ignore_patterns(setting):
        if pattern.startswith("#"):
            continue
        keep = pattern.startswith("!")
        regex = _glob_regex(pattern[1:] if keep else pattern)
        ignored = F.when(F.regexp_like(path, F.lit(regex)), F.lit(not keep)).otherwise(ignored)
    return ignored


def is_binary(content: Column) -> Column:
    """Whether ``content`` looks like anything but text.

    Missing content counts as binary, and so do NUL bytes. Other bytes that
    are not UTF-8 are fine, as in older encodings, while control characters
    stay below a tenth.
    """
    raw = content.cast("string")
    shown = F.octet_length(raw)
    controls = shown - F.octet_length(
        F.translate(raw, "".join(map(chr, [*range(1, 9), *range(14, 27), *range(28, 32), 127])), "")
    )
    return F.coalesce(
        F.when(shown == 0, F.lit(False)).otherwise(
            F.contains(raw, F.lit("\0")) | (controls * 10 > shown)
        ),
        F.lit(True),
    )
