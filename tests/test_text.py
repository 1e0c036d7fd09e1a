import hashlib

import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.functions.analysis import lexeme, query_phrases, stem
from lodestone.functions.bytesops import line_ending
from lodestone.operators.dispatch import family_of, language_of
from lodestone.sources.files import is_binary, is_ignored


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_slugs(spark):
    for text, slug in [(" Hello, World! ", "hello-world"), ("A  B---C", "a-b-c"), ("- Ünï -", "n")]:
        assert value(spark, X.slugify(F.lit(text))) == slug


def test_requirement_sentences_are_distinct_and_whole_words(spark):
    text = "System shall log. System shall log. It should validate. Mustard is no duty! A USE CASE? end"
    got = value(spark, X.requirement_sentences(F.lit(text)))
    assert got == ["System shall log.", "It should validate.", "A USE CASE?"]
    assert value(spark, X.requirement_sentences(F.lit("nothing here"))) == []


def test_code_refs_are_trimmed_sorted_and_tagged(spark):
    got = value(spark, X.code_refs(F.lit("use `b` and ` a ` and `b` and ` `"), F.array(F.lit("sql"))))
    assert got == ["a", "b", "fence:sql"]


def test_signature_drops_empty_parts_and_shortens(spark):
    args = F.lit("p"), F.lit(1), F.lit(9)
    none = F.array().cast("array<string>")
    assert value(spark, X.document_signature(F.lit(""), *args, none, F.lit("  "))) == "p|1-9|doc-chunker-v1"
    crumb = F.array(F.lit("A"), F.lit("B"))
    got = value(spark, X.document_signature(F.lit("r"), *args, crumb, F.lit("word " * 30)))
    repo, path, span, crumbs, shown, version = got.split("|")
    assert (repo, path, span, crumbs, version) == ("r", "p", "1-9", "A/B", "doc-chunker-v1")
    assert len(shown) == 80 and shown.endswith("...")


def test_id_counts_a_missing_branch_as_empty(spark):
    got = value(spark, X.chunk_id(F.lit("r"), F.lit(None).cast("string"), F.lit("p"), F.lit(0), F.lit(5)))
    assert got == hashlib.sha256(b"r::::p::0::5").hexdigest()


def test_kinds_by_precedence(spark):
    some, none = F.array(F.lit("x")), F.array().cast("array<string>")
    for types, requirements, kind in [
        (["table", "csv"], some, "table"), (["list", "fence"], none, "fence"), (["json"], some, "json"),
        (["paragraph"], some, "req"), (["paragraph"], none, "doc"), (["text"], some, "text"),
    ]:
        assert value(spark, X.chunk_kind(F.array(*map(F.lit, types)), requirements)) == kind


def test_line_endings(spark):
    for data, eol in [(b"a\r\nb\n", "\r\n"), (b"a\nb\r\n", "\n"), (b"\n", "\n"), (b"a", ""), (b"a\n", "\n")]:
        assert value(spark, line_ending(F.lit(data))) == eol


def test_extensions_choose_family_and_language(spark):
    for path, ext, family, language in [
        ("a/b.PY", "py", "code", "python"), ("x.tar.md", "md", "markdown", "markdown"),
        ("x.lock", "lock", "markup", "yaml"), (".env", "", "text", "text"), ("a.d/noext", "", "text", "text"),
        ("q.ndjson", "ndjson", "jsonl", "jsonl"), ("s.h", "h", "code", "cpp"), ("w.log", "log", "text", "text"),
    ]:
        e = X.extension(F.lit(path))
        assert value(spark, F.array(e, family_of(e), language_of(e))) == [ext, family, language]


def test_ignore_patterns_take_the_last_match(spark):
    setting = "dist/**, *.min.js; build/ , !dist/keep.txt,/top.txt"
    for path, ignored in [
        ("dist/a/b.txt", True), ("dist/keep.txt", False), ("a/b.min.js", True), ("a/build/c", True),
        ("build", False), ("top.txt", True), ("a/top.txt", False), ("src/x.js", False),
    ]:
        assert value(spark, is_ignored(F.lit(path), setting)) == ignored, path


def test_binary_content(spark):
    for data, binary in [(b"text\n", False), (b"", False), (b"\x89PNG\0\0", True), (b"\xff\xfeab", False), (None, True)]:
        assert value(spark, is_binary(F.lit(data).cast("binary"))) == binary


@pytest.mark.parametrize("word,expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("gas", "gas"),
    ("agreed", "agre"), ("hopping", "hop"), ("hoping", "hope"), ("sized", "size"), ("luxuriated", "luxuri"),
    ("generically", "generic"), ("relational", "relat"), ("conditional", "condit"), ("happy", "happi"),
    ("say", "say"), ("sky", "sky"), ("dying", "die"), ("consolations", "consol"), ("knightly", "knight"),
    ("national", "nation"), ("adjustment", "adjust"), ("adoption", "adopt"), ("controlling", "control"),
    ("communication", "communic"), ("youthful", "youth"), ("skis", "ski"), ("news", "news"),
    ("exceed", "exceed"), ("kiwis", "kiwi"), ("databases", "databas"), ("queries", "queri"),
])
def test_english_stems(word, expected):
    assert stem(word) == expected


def test_stop_words_and_phrases():
    assert lexeme("the") == "" and lexeme("running") == "run"
    assert query_phrases("Foo_bar baz! _ éa") == [["foo", "bar"], ["baz"], ["a"]]
    assert query_phrases("--- ") == []


def test_markup_escape_and_rendering(spark):
    got = value(spark, X.escape_markup(F.lit('if x < y: print("a & b")')))
    assert got == "if x &lt; y: print(&quot;a &amp; b&quot;)"
    tag = value(spark, X.file_tag(F.lit("a'b"), F.lit("r"), F.lit(None).cast("string"), F.lit("<x>")))
    assert tag == '<file path="a&#x27;b" repo="r" branch="None">\n&lt;x&gt;\n</file>'
    assert value(spark, X.markdown_block(F.lit("p"), F.lit("go"), F.lit("x"))) == "### p\n\n```go\nx\n```"
