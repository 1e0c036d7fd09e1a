import json
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators.chunk import chunk_files
from lodestone.operators.lines import line_blocks
from lodestone.operators.structure import json_spans, markdown_blocks

MARKDOWN = (
    "Title\n=====\n\n## Section\n\n```python\nprint('x')\n```\n\n|a|b|\n|1|2|\n\n"
    "- item one\n- item two\n\n> quote\nplain after\n\nSub\n~~~\ntext\n\n# New #\nend"
)


def test_markdown_blocks_and_breadcrumbs():
    found = [(k, crumb, lang) for _, _, k, crumb, _, lang in markdown_blocks(MARKDOWN.splitlines(True))]
    section = ["Title", "Section"]
    assert found == [
        ("heading", ["Title"], None), ("heading", section, None), ("fence", section, "python"),
        ("table", section, None), ("list", section, None), ("blockquote", section, None),
        ("paragraph", section, None), ("heading", [*section, "Sub"], None),
        ("paragraph", [*section, "Sub"], None), ("heading", ["New"], None), ("paragraph", ["New"], None),
    ]


def test_text_above_a_bare_fence_is_a_heading():
    kinds = [b[2] for b in markdown_blocks(["intro\n", "```\n", "x\n"])]
    assert kinds == ["heading", "paragraph"]


def test_open_fence_runs_to_the_end_and_closes_with_as_many_marks():
    lines = ["````sql\n", "x\n", "```\n", "`````\n", "after\n"]
    assert [(a, b, k) for a, b, k, *_ in markdown_blocks(lines)] == [(0, 4, "fence"), (4, 5, "paragraph")]
    assert [b[1] for b in markdown_blocks(["~~~\n", "x\n"])] == [2]


def test_json_members_cover_their_text():
    text = '\n{\n  "a": 1,\n  "b": [1, {"c": 2}] ,\n\n  "é": "x"\n}\n'
    spans = json_spans(text)
    assert [c for *_, c in spans] == [["a"], ["b"], ["é"]]
    assert spans[0][0] == 1 and spans[-1][1] == len(text)
    assert text[spans[1][0]:spans[1][1]] == '  "b": [1, {"c": 2}] ,'
    assert [c for *_, c in json_spans('[1, "x", {}]')] == [["[0]"], ["[1]"], ["[2]"]]


@pytest.mark.parametrize("text,expected", [
    ("{invalid json}", [("{invalid json}", [])]), ("", []), ("  ", []), ("nope", []), ("12 13", []), (" 12 ", [("12 ", [])]),
    ("{}", [("{}", [])]), ("[]", [("[]", [])]), ('{"a":1, "b" 2}', [('{"a":1,', ["a"]), (' "b" 2}', [])]),
    ("[1, oops, 3]", [("[1,", ["[0]"]), (" oops,", ["[1]"]), (" 3]", ["[2]"])]),
    ('{"a": "open,\n "b": 2,\n "c": 3}', [('{"a": "open,', ["a"]), (' "b": 2,', ["b"]), (' "c": 3}', ["c"])]),
    ('{"a": [1, 2, "b": 3}\n[4]', [('{"a": [1, 2, "b": 3}\n', ["a"]), ("[4]", ["[0]"])]),
    ('{"a":1}\n{"b":2}', [('{"a":1}\n', ["a"]), ('{"b":2}', ["b"])]),
    ('{"a":1} rest\nmore\n[1]\n', [('{"a":1} ', ["a"]), ("rest\nmore\n", []), ("[1]\n", ["[0]"])]),
    ('{"a": 1}}', [('{"a": 1}', ["a"]), ("}", [])]), ('{"a', [('{"a', [])]), ('{"a":1,}', [('{"a":1,}', ["a"])]),
    ('{"a\\"b": "x,}", "c": {"d": [1,2]}, }', [('{"a\\"b": "x,}",', ['a"b']), (' "c": {"d": [1,2]}, }', ["c"])]),
])
def test_json_spans_of_sound_and_broken_text(text, expected):
    assert [(text[a:b], crumb) for a, b, crumb in json_spans(text)] == expected


@pytest.mark.parametrize("seed", range(20))
def test_no_json_text_is_lost(seed):
    chosen = random.Random(seed)
    value = {f"k{i}": chosen.choice([i, "s, {[" * 3, [1, {"x": None}], {"y": [[]]}]) for i in range(8)}
    text = json.dumps(value if seed % 2 else list(value.values()), indent=chosen.choice([None, 2]))
    for _ in range(seed):
        at = chosen.randrange(len(text))
        text = text[:at] + chosen.choice(["", '"', "}", "]", "{", "[", ",", "\n", "\\"]) + text[at + 1:]
    spans = json_spans(text)
    if spans:
        assert all(a < b <= c for (a, b, _), (c, _, _) in zip(spans, spans[1:]))
        edges = [0, *[x for span in spans for x in span[:2]], len(text)]
        assert not "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])).strip()


def test_deep_brackets_take_linear_time():
    text = "[" * 200_000 + "}" * 200_000 + "]" * 10
    assert json_spans(text)[-1][1] == len(text)


@pytest.fixture
def lined(spark):
    def blocks(family, *texts):
        rows = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "i int, content binary")
        found = rows.select("i", line_blocks(F.col("content"), F.lit(family)).alias("b")).orderBy("i").collect()
        return [r.b for r in found]

    return blocks


def test_json_lines_keep_their_numbers(lined):
    found, = lined("jsonl", '{"a":1}\n\n{"b":2}\n')
    assert [(b.start, b.end, b.crumb) for b in found] == [(0, 8, ["line 1"]), (9, 17, ["line 3"])]


def test_sections_absorb_blank_indented_and_comment_lines(lined):
    text = "\n# lead\nserver:\n  port: 1\n\n# note\nlist:\n- a\n\tb\n"
    found, = lined("yaml", text)
    assert [text[b.start:b.end] for b in found] == [
        "# lead\n", "server:\n  port: 1\n\n# note\n", "list:\n", "- a\n", "\tb\n",
    ]
    assert [b.crumb for b in found] == [[], ["server"], ["list"], ["a"], []]


@pytest.mark.parametrize("text,name", [
    ("[a.b]\nx = 1", "a.b"), ("[[ t ]]", "t"), ("[a] # note", "a] # note"), ("[open\n  k: v", "k"), ("key : v = 2", "key"), ("k= v", "k"),
    ("- item", "item"), ("-", "-"), ("- a: b", "- a"), ("--- \nreal: 1", "--"), (": x", None), ("# c\n  # d: e\n  f: g", "f"), ("plain\n  k: v", "k"), ("plain", None),
])
def test_section_names(lined, text, name):
    found, = lined("toml", text)
    assert found[0].crumb == ([name] if name else [])


def test_offsets_count_bytes(lined):
    found, = lined("jsonl", '{"é":"漢"}\n{"b":1}\n')
    assert [(b.start, b.end) for b in found] == [(0, 13), (13, 21)]


def plain_sections(text):
    """The rule read line by line."""
    lines, at, out = text.splitlines(keepends=True), 0, []
    places = []
    for line in lines:
        places.append((at, at + len(line.encode()), line))
        at += len(line.encode())
    written = [i for i, p in enumerate(places) if p[2].strip()]
    starts = [i for i in written if i == written[0] or (not places[i][2].startswith(" ") and not places[i][2].lstrip().startswith("#"))]
    for a, b in zip(starts, [*starts[1:], len(lines)]):
        out.append((places[a][0], places[b - 1][1]))
    return out


def test_lines_end_where_python_ends_them(lined):
    chosen = random.Random(5)
    ends = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\u2028", "", "\n\n", " \u3000\n"]
    texts = ["".join(chosen.choice(["a: é", "  b", "# c", "-", "", "\xa0x", "漢"]) + chosen.choice(ends) for _ in range(chosen.randrange(400)))
             for _ in range(25)]
    for text, found in zip(texts, lined("yaml", *texts), strict=True):
        assert [(b.start, b.end) for b in found] == plain_sections(text)
    for text, found in zip(texts, lined("jsonl", *texts), strict=True):
        assert [int(b.crumb[0].split()[1]) for b in found] == [i for i, line in enumerate(text.splitlines(), 1) if line.strip()]


def test_document_chunks_of_all_families(make_files):
    data = {
        "a.md": MARKDOWN, "b.json": json.dumps({"k": "v" * 3000, "l": "w" * 3000, "m": 1}),
        "c.yaml": "a:\n  - 1\nb:\n  - " + "2" * 600 + "\n", "d.toml": "[s]\nk = 1\n", "e.csv": "a,b\n1,2\n",
        "f.tsv": "a\tb\n", "g.txt": "It must work. `x`", "h.bin2": b"\xff\xfe text must be\n" * 300,
        "empty.txt": b"", "i.md": "   \n", "j.json": "nope",
    }
    rows = chunk_files(make_files(data)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.path, []).append(r)
    for found in by.values():
        found.sort(key=lambda r: r.start_bytes)
    assert "empty.txt" not in by
    assert [(r.language, r.chunk_kind) for r in by["a.md"]] == [("markdown", "table")]
    assert by["a.md"][0].code_refs == ["fence:python", "python\nprint('x')"] and by["a.md"][0].anchors == ["title"]
    assert [r.heading_breadcrumb for r in by["b.json"]] == [["k"], ["l"]]
    assert [r.heading_breadcrumb for r in by["c.yaml"]] == [["a"], ["b"]]
    assert (by["d.toml"][0].language, by["d.toml"][0].chunk_kind) == ("toml", "toml")
    assert (by["e.csv"][0].chunk_kind, by["e.csv"][0].table_delimiter) == ("table", ",")
    assert (by["f.tsv"][0].language, by["f.tsv"][0].table_delimiter) == ("tsv", "\t")
    assert by["g.txt"][0].chunk_kind == "text" and by["g.txt"][0].code_refs == ["x"]
    assert {(r.language, r.chunk_kind) for r in by["h.bin2"]} == {("text", "req")}
    assert by["h.bin2"][0].chunk.startswith("\ufffd\ufffd text")
    assert by["i.md"][0].language == "text" and by["j.json"][0].language == "text"
    assert all(r.grammar_version == "doc-chunker-v1" and r.overlap_bytes == 256 for r in rows)
    assert len({r.id for r in rows}) == len(rows)


def test_big_markdown_packs_to_the_soft_size_and_starts_at_headings(make_files):
    text = "".join(f"# Part {i}\n\n" + ("word " * 100 + "\n") * 5 + "\n" for i in range(6))
    rows = sorted(chunk_files(make_files({"a.md": text})).collect(), key=lambda r: r.end_bytes)
    assert len(rows) > 3
    edges = [0, *[r.end_bytes for r in rows]]
    assert edges[-1] == len(text)
    assert all(b - a <= 4096 for a, b in zip(edges, edges[1:]))
    assert rows[0].heading_breadcrumb == ["Part 0"]


@pytest.mark.parametrize("name", ["a.java", "b.py", "c.html", "d.css", "f.xml"])
def test_source_and_markup_are_covered_without_gaps(make_files, name):
    text = "<p>" * 1500 + "\n".join(f"void m{i}(int a, int b) {{ say({i}); }}" for i in range(300)) + "\n"
    rows = chunk_files(make_files({name: text, "empty_" + name: ""})).orderBy("start_bytes").collect()
    assert {r.path for r in rows} == {name}
    assert rows[0].start_bytes == 0 and rows[-1].end_bytes == len(text)
    assert all(b.start_bytes <= a.end_bytes for a, b in zip(rows, rows[1:]))
    assert all(r.chunk == text[r.start_bytes:r.end_bytes] and len(r.chunk) <= 2048 for r in rows)


def test_lines_are_split_at_the_same_places_with_and_without_rare_ends(spark):
    from lodestone.operators.lines import split_lines, stripped

    chosen = random.Random(11)
    ends = ["\n", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
    blanks = [" ", "\t", "\x1f", "\xa0", " ", " ", " ", " ", "　", "a", "é", "​"]
    texts = ["", "\n", "a", "a\n", "\n\na"] + [
        "".join(chosen.choices(blanks + (["\n"] if n % 2 else ends), k=chosen.randrange(40))) for n in range(400)]
    rows = spark.createDataFrame(enumerate(texts), "n int, s string")
    found = rows.select("n", split_lines(F.col("s")).alias("lines"), stripped(F.col("s")).alias("bare")).collect()
    python = {n: t.splitlines(keepends=True) for n, t in enumerate(texts)}
    assert {r.n: r.lines for r in found} == python
    assert {r.n: r.bare for r in found} == {n: t.strip() for n, t in enumerate(texts)}
