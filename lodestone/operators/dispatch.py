"""Which rules a file is cut by, from its name and its bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import config as C
from lodestone.functions.text import extension

# Families whose block borders need a look at the structure of the text.
STRUCTURED = ("markdown", "json", "jsonl", "yaml", "toml")


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, key)


def family_of(ext: Column) -> Column:
    """``code``, then a document family, then ``markup``, else ``text``."""
    return F.coalesce(
        F.when(ext.isin(*C.CODE_LANGUAGES), F.lit("code")),
        _lookup(C.DOCUMENT_FAMILIES, ext),
        F.when(ext.isin(*C.MARKUP_LANGUAGES), F.lit("markup")),
        F.lit("text"),
    )


def language_of(ext: Column) -> Column:
    """Language tag by name alone; unknown endings are plain text."""
    return F.coalesce(
        _lookup({**C.MARKUP_LANGUAGES, **C.DOCUMENT_FAMILIES, **C.CODE_LANGUAGES}, ext),
        F.lit("text"),
    )


def dispatch(files: DataFrame) -> DataFrame:
    """Add ``ext``, ``family`` and ``language``; a document that is not UTF-8 is ``bytes``."""
    ext = extension(F.col("path"))
    named = files.withColumn("ext", ext)
    family = family_of(F.col("ext"))
    readable = F.is_valid_utf8(F.col("content").cast("string"))
    by_name = named.withColumn("family", family).withColumn("language", language_of(F.col("ext")))
    return by_name.withColumn(
        "family",
        F.when(F.col("family").isin("code", "markup") | readable, F.col("family")).otherwise(
            F.lit("bytes")
        ),
    )
