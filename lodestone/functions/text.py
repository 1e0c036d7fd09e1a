"""Text rules as Column expressions: slugs, sentences, references, signatures."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone import config as C

# White space in the Unicode sense, including the four ASCII separators.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"

# Fixed value: words that mark a sentence as a requirement.
REQUIREMENT_WORDS = ["shall", "must", "should", "required", "use case", "scenario"]
REQUIREMENT = r"(?iu)(?U)\b(?:" + "|".join(REQUIREMENT_WORDS) + r")\b"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def slugify(text: Column) -> Column:
    kept = F.regexp_replace(F.lower(strip(text)), f"[^a-z0-9{SPACE}-]", "")
    return F.trim(F.regexp_replace(kept, f"[{SPACE}-]+", "-"), F.lit("-"))


def requirement_sentences(text: Column) -> Column:
    """Distinct sentences with a requirement word, in order of appearance.

    No requirement word spans two sentences, so a text without the letters of
    any is left alone before it is split.
    """
    upper = F.upper(text)
    possible = reduce(or_, [F.contains(upper, F.lit(w.upper())) for w in REQUIREMENT_WORDS])
    sentences = F.filter(
        F.split(text, f"(?<=[.!?])[{SPACE}]+"), lambda s: F.regexp_like(s, F.lit(REQUIREMENT))
    )
    return F.when(possible, F.array_distinct(F.transform(sentences, strip))).otherwise(
        F.array().cast("array<string>")
    )


def inline_code(text: Column) -> Column:
    """Distinct texts between single backticks, in order of appearance."""
    found = F.regexp_extract_all(text, F.lit("`([^`]+)`"), F.lit(1))
    return F.when(
        F.contains(text, F.lit("`")),
        F.array_distinct(F.filter(F.transform(found, strip), lambda s: s != "")),
    ).otherwise(F.array().cast("array<string>"))


def code_refs(text: Column, fences: Column) -> Column:
    """Sorted inline code plus one entry per fence language."""
    tagged = F.transform(fences, lambda lang: F.concat(F.lit("fence:"), lang))
    return F.array_sort(F.array_union(inline_code(text), tagged))


def preview(text: Column) -> Column:
    line = squeeze(F.substring(text, 1, 120))
    return F.when(F.length(line) > 80, F.concat(F.substring(line, 1, 77), F.lit("..."))).otherwise(line)


def document_signature(
    repo: Column, path: Column, start: Column, end: Column, crumb: Column, text: Column
) -> Column:
    """``repo|path|start-end|crumb|preview|version`` without the empty parts."""
    return F.concat_ws(
        "|",
        F.nullif(repo, F.lit("")),
        path,
        F.concat(start.cast("string"), F.lit("-"), end.cast("string")),
        F.nullif(F.array_join(crumb, "/"), F.lit("")),
        F.nullif(preview(text), F.lit("")),
        F.lit(C.DOC_VERSION),
    )


def chunk_id(repo: Column, branch: Column, path: Column, start: Column, end: Column) -> Column:
    key = F.concat_ws(
        "::", repo, F.coalesce(branch, F.lit("")), path, start.cast("string"), end.cast("string")
    )
    return F.sha2(key, 256)


def chunk_kind(types: Column, requirements: Column) -> Column:
    """The first kind that applies; plain prose with requirements is ``req``."""
    kind = F.coalesce(
        *[
            F.when(F.array_contains(types, name), F.lit(name))
            for name in ("table", "fence", "json", "yaml", "toml", "csv", "tsv", "text")
        ]
    )
    return F.coalesce(
        kind, F.when(F.size(requirements) > 0, F.lit("req")).otherwise(F.lit("doc"))
    )


def extension(path: Column) -> Column:
    """Lower-case suffix without the dot; empty for names like ``.env``."""
    name = F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)
    return F.lower(F.regexp_extract(name, r"^\.*[^.].*\.([^.]+)$", 1))


def escape_markup(text: Column) -> Column:
    for plain, entity in (
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"),
    ):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def file_tag(path: Column, repo: Column, branch: Column, chunk: Column) -> Column:
    """One hit as a ``<file>`` element that is safe to embed in markup."""
    return F.concat(
        F.lit('<file path="'), escape_markup(path),
        F.lit('" repo="'), escape_markup(repo),
        F.lit('" branch="'), escape_markup(F.coalesce(branch, F.lit("None"))),
        F.lit('">\n'), escape_markup(chunk), F.lit("\n</file>"),
    )


def markdown_block(path: Column, language: Column, chunk: Column) -> Column:
    return F.concat(
        F.lit("### "), path, F.lit("\n\n```"), language, F.lit("\n"), chunk, F.lit("\n```")
    )
