"""Tokenizer, exact copies, mixing and page texts against plain readings."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.llm import bpe, exact_dedup, html_text, mixing, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, copies int, row int, id string"


@pytest.fixture
def make_docs(spark):
    def make(rows):
        full = [(i, t, "en", s, len(t or ""), 7, 7, 7, "x") for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return make


AWKWARD = [
    (1, "Alpha beta  gamma", "a"), (2, "Alpha\tbeta gamma ", "a"), (3, None, None), (4, "", "b"), (5, " \n", "b"),
    (6, "x" * 70_000 + " é😀 " + "y" * 1500 + " " * 3000 + "z", "a"), (7, "Alpha beta  gamma", "c"),
    (7, "Alpha beta  gamma", "c"), (None, "Alpha beta gamma", None), (9, "don't stop\r\n\r\n  now", ""),
]


# --- tokenizer -----------------------------------------------------------------

def test_bpe_is_the_library_and_round_trips(make_docs):
    got = bpe.encode_decode(make_docs(AWKWARD)).collect()
    library = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    assert len(got) == len(AWKWARD)
    texts = {i: t or "" for i, t, _ in AWKWARD}
    for row in got:
        assert bytes(row.decoded) == texts[row.doc_id].encode()
        if row.doc_id != 6:
            assert row.ids == library.encode_ordinary(texts[row.doc_id])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1'. \n\t é😀st"), max_size=60), st.integers(1, 9))
def test_pieces_are_cut_at_borders_of_the_pattern(text, size):
    library = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    parts = list(bpe.pieces(text, size))
    assert "".join(p for p, _ in parts) == text
    assert [i for p, _ in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" + " " * 1200 + "b", "\n" * 1100, "a" + "\t" * 1001 + "\n", "x " + " " * 1000 + "　y"])
def test_long_white_space_is_one_match(text):
    library = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    assert bpe.encode(text, library) == library.encode_ordinary(text)


def test_digests_and_empty_table(make_docs):
    docs = make_docs(AWKWARD)
    got = {r.doc_id: r for r in bpe.digests(bpe.encode_decode(docs)).collect()}
    assert got[3].n_tokens == 0 and got[3].ids_sha256 == got[4].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[9].decoded_sha256 == hashlib.sha256(AWKWARD[-1][1].encode()).hexdigest()
    assert bpe.digests(bpe.encode_decode(docs.where("false"))).count() == 0


# --- counts under edits ----------------------------------------------------------

@pytest.mark.parametrize("size", [4, 256])
def test_counts_follow_edits(monkeypatch, size):
    monkeypatch.setattr(token_counts, "SEGMENT_CHARS", size)
    library = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    chosen = random.Random(size)
    parts = ["a", "b", " ", "  ", "\n", "don't", "1", "é😀", "!", "\t", " x"]
    for _ in range(300):
        text = "".join(chosen.choice(parts) for _ in range(chosen.randrange(60)))
        tree = token_counts.Counted(token_counts.segments(text, library), library)
        for _ in range(4):
            start = chosen.randrange(-2, len(text) + 3)
            stop, new = start + chosen.randrange(-1, 12), chosen.choice(parts) * chosen.randrange(3)
            tree.edit(start, stop, new)
            a = min(max(start, 0), len(text))
            text = text[:a] + new + text[min(max(stop, a), len(text)):]
            assert "".join(leaf.text for leaf in token_counts.leaves_of(tree.tree)) == text
            assert tree.tokens == len(library.encode_ordinary(text))


def test_edits_touch_a_part_of_a_long_text():
    library = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    tree = token_counts.Counted(token_counts.segments("some words " * 20_000, library), library)
    for i in range(100):
        tree.edit(i * 2000, i * 2000 + 3, "other")
    assert tree.encoded < 100 * 1200 and tree.tree.depth <= 80


def test_edited_table(spark, make_docs):
    docs = make_docs(AWKWARD)
    library = bpe.encoding(public_tokenizers.path(bpe.RANKS))
    state = token_counts.counted(docs)
    edits = F.when(F.col("doc_id") != 2, F.expr(
        "array(named_struct('start', 3, 'stop', 5, 'text', ' new'), named_struct('start', null, 'stop', null, 'text', null))"))
    got = token_counts.edited(state, edits).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in AWKWARD)
    texts = {i: t or "" for i, t, _ in AWKWARD}
    for r in got:
        old = texts[r.doc_id]
        assert r.text == (old if r.doc_id in (2, None) else old[:3] + " new" + old[5:])
        assert r.n_tokens == len(bpe.encode(r.text, library)) == sum(r.leaf_tokens)
        assert r.n_tokens_before == len(bpe.encode(old, library)) and sum(r.leaf_chars) == len(r.text)
    assert token_counts.edited(state.where("false"), edits).count() == 0


# --- exact copies --------------------------------------------------------------

def plain_groups(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), i is None, i or 0, i))
    best = {k: min(v)[3] for k, v in groups.items()}
    return sorted(
        (str(i), str(best[k]), len(groups[k]), i == best[k]) for k, v in groups.items() for *_, i in v
    )


@pytest.mark.parametrize("seed", range(3))
def test_exact_groups(make_docs, seed):
    chosen = random.Random(seed)
    rows = AWKWARD + [
        (100 + i, "".join(chosen.choice(["ab", "a b", " ", "c\n"]) for _ in range(chosen.randrange(4))), "s")
        for i in range(150)
    ]
    got = exact_dedup.exact_groups(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == plain_groups(rows)


def test_equal_hashes_do_not_make_equal_texts(spark, make_docs):
    docs = make_docs([(i, t, "s") for i, t in enumerate(["abc", "abd", "a bc", "xyz", "abd"])]).repartition(3)
    got = exact_dedup.text_owners(docs, code=lambda c: F.lit(1)).collect()
    assert sorted((r.keep_id, r.group_size) for r in got) == [(1, 2), (2, 2), (3, 1)]


@given(st.lists(st.binary(max_size=6), max_size=40))
def test_trie_owns_every_string(texts):
    trie = exact_dedup.Trie()
    for i, text in enumerate(texts):
        trie.insert(text, [len(text), i, 1, 1])
    want = {t: [len(t), texts.index(t), n, 1] for t, n in Counter(texts).items()}
    assert dict(trie.terminals()) == want
    assert dict(trie.cut()) == want and trie.size == 0 and not list(trie.terminals())


def test_spilled_subtrees_meet_again():
    import pyarrow as pa

    rows = [(3, 1, b"abc", 3, i, 1, 1) for i in range(5)] + [(3, 1, b"abd", 3, 9, 1, 1)] * 4
    names = ["length", "content_hash", "normal", "chars", "doc_id", "n", "ties"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    parts = list(exact_dedup._owners_of_task([batch], spill=2))
    merged = [r for b in exact_dedup._merged(parts) for r in b.to_pylist()]
    assert sum(b.num_rows for b in parts) > 2
    assert {(r["normal"], r["doc_id"], r["n"], r["ties"]) for r in merged} == {(b"abc", 0, 5, 1), (b"abd", 9, 4, 4)}


def test_without_copies_keeps_all_columns(make_docs):
    docs = make_docs(AWKWARD)
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 5, 6, 9])
    assert exact_dedup.without_copies(docs.where("false")).count() == 0


def test_one_row_of_each_group_stays(make_docs):
    rows = [(1, "a b", "s")] * 3 + [(None, "c d", "s")] * 2 + [(1, "ab", "s"), (2, "a  b", "t"), (None, "cd", "s"), (3, "e", "s"), (3, "e f", "s")]
    docs = make_docs(rows).repartition(4)
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "a  b"), ("3", "e"), ("3", "e f"), ("None", "c d")]
    tied = exact_dedup.without_copies(make_docs([(1, "a b", "s")] * 3 + [(None, "c", "s")] * 2))
    assert sorted((str(r.doc_id), r.text) for r in tied.collect()) == [("1", "a b"), ("None", "c")]


# --- mixing --------------------------------------------------------------------

def plain_targets(sizes):
    """Targets by capping one source after the other."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] < level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def test_mixing_meets_targets(make_docs):
    chosen = random.Random(4)
    rows = [(i, "w " * chosen.randrange(60), chosen.choice(["a"] * 9 + ["b", "é", "", None])) for i in range(1200)]
    rows += [(5000, None, "a"), (5001, "w " * 50, "tiny"), (None, "w", "b")]
    docs = make_docs(rows)
    got = mixing.mixed_sizes(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken, source = plain_targets(sizes), Counter(), {i: s for i, _, s in rows}
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert s == "tiny" or abs(taken[s] - want[s]) <= max(0.05 * want[s], 60)
    again = {r.doc_id: r.taken for r in mixing.mixed_sizes(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    copies = Counter(r.doc_id for r in mixing.mix(docs).where("text <> ''").collect())
    assert all(copies[r.doc_id] * r.size == r.taken for r in got if r.size)
    assert mixing.mix(docs).columns == docs.columns


def test_mixing_of_nothing(make_docs):
    docs = make_docs([(1, None, None), (2, " ", "a")])
    assert [r.taken for r in mixing.mixed_sizes(docs).collect()] == [0, 0]
    assert mixing.mixed_sizes(docs.where("false")).count() == mixing.mix(docs.where("false")).count() == 0


# --- pages ---------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><p>no</p>";</script></head>
<body class="header-fixed"><header><h1>Site</h1></header><div class="cookie-notice"><p>We use cookies and hope you agree
with it, now please click the button below</p></div><nav><ul><li><a href=/>Home</a></li></ul></nav><main><article>
<header><h1>Real  title</h1></header><p>One &lt;x&gt;<br>caf&eacute; &amp co<p>Two <a href="y>z">linked</a> words
<!-- <p>hidden</p> --><aside><p>A long remark at the side that nobody wants to see in the main text at all</p></aside>
<form><label>Mail</label><input></form><div class="ad">Buy now</div><p>L<b>as</b>t.</article><section id="comments">
<article><p>I liked this article a lot, thank you for it, and all the best to you.</p></article></section></main>
<div class="sidebar"><p>Popular</p></div><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == "Real title\nOne <x> café & co\nTwo linked words\nLast."


def test_page_without_article():
    page = "<div id=menu><a href=1>Home</a></div><h2>News of the day</h2><div>" + "Some words of a text. " * 9 + (
        "</div><div>" + "And more of it. " * 8 + "</div><div><a>x</a> <a>y</a></div>")
    assert html_text.main_text(page).split("\n")[0] == "News of the day"
    assert html_text.main_text(page).count("\n") == 2


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<p>" * 3000, "<a <b " * 500, "&#0;&#xFFFFFFFF;", "<!-- x", "<script>x"])
def test_odd_pages(page):
    assert isinstance(html_text.main_text(page), str)


def test_extract_table(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, None, None, 5), (None, "v", "", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_text.extract(pages).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 51, 51] and all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(pages.where("false")).count() == 0


def test_raw_elements_take_no_text_after_them():
    text = " ".join(["The ship left the harbour early and came back with fish for the market."] * 4)
    for tag in ("<svg-icon name='a'>", "<video-js>", "<svg viewBox='0 0 1 1'/>", "<math/>", "<audio>", "<template>"):
        page = f"<html><body><article><p>{text}</p>{tag}<p>{text} End.</p></article></body></html>"
        assert html_text.main_text(page) == f"{text}\n{text} End.", tag
    page = f"<article><p>{text}</p><svg><title>no</title></svg><script>no<p>no</p></article>"
    assert html_text.main_text(page) == text


PROSE = " ".join(["Long words of the article stand here."] * 24)


@pytest.mark.parametrize("name", [
    "content has-sidebar", "content-sidebar-wrap", "post nav-below", "widget-area content", "article-tags",
    "entry-content related-posts-enabled", "content",
])
def test_an_article_in_a_named_wrapper_stays(name):
    page = (f'<html><body><nav><a href="/">Home</a></nav><div class="{name}"><article><h1>Title</h1><p>{PROSE}</p>'
            "</article></div><footer>c</footer></body></html>")
    assert html_text.main_text(page) == f"Title\n{PROSE}"


def test_names_that_hint_leave_the_say_to_words_and_links():
    page = f'<html><body><div class="post comment-enabled"><h1>Title</h1><p>{PROSE}</p></div></body></html>'
    assert PROSE in html_text.main_text(page)
    inside = (f'<article><h1>T</h1><p>{PROSE}</p><section class="share-price"><p>{PROSE}</p></section>'
              f'<div class="figure alert-level"><p>{PROSE}</p></div><div class="share-this"><a href="/s">Share it</a></div></article>')
    assert html_text.main_text(f"<html><body>{inside}</body></html>") == f"T\n{PROSE}\n{PROSE}\n{PROSE}"


@pytest.mark.parametrize("name", [
    "comments", "comment-list", "related-posts", "cookie-banner", "sidebar", "site-footer", "newsletter-signup", "ad-slot",
    "main-nav", "user-comments",
])
def test_long_text_in_what_is_no_content_goes(name):
    page = (f'<html><body><div class="text"><h1>Title</h1><p>{PROSE}</p></div><div class="{name}"><p>{PROSE}</p></div>'
            "</body></html>")
    assert html_text.main_text(page) == f"Title\n{PROSE}"


@pytest.mark.parametrize("tag", ["select", "textarea", "object", "video", "svg", "canvas"])
def test_an_element_left_open_takes_no_text(tag):
    page = (f"<html><body><article><p>one two three</p><{tag}><option>a<p>{PROSE}</p></article>"
            f"<form><{tag}><option>b</{tag}></form></body></html>")
    assert PROSE in html_text.main_text(page)
