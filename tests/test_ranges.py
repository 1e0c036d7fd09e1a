import pytest
from pyspark.sql import functions as F

import slow
from lodestone.functions.bytesops import let, nearest_newline, newlines_in, point_col, point_row
from lodestone.operators.chunk import chunk_plaintext
from lodestone.operators.ranges import cover, newline_ranges, split_span

TEXTS = list(slow.texts(120))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, bytearray(t.encode())) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "n int, content binary").cache()


def spans(corpus, build):
    rows = corpus.select("n", let(F.col("content"), build).alias("s")).collect()
    return {r.n: [(x.start, x.end) for x in r.s] for r in rows}


def test_pieces_follow_line_ends_and_caps(corpus):
    got = spans(corpus, lambda c: split_span(c, F.lit(0), F.octet_length(c)))
    for i, t in enumerate(TEXTS):
        assert got[i] == slow.parts(t.encode()), i


@pytest.mark.parametrize("soft,hard,overlap", [(1024, 2048, 0), (1024, 2048, 102), (2048, 4096, 256)])
def test_ranges_cut_at_the_closest_newline(corpus, soft, hard, overlap):
    got = spans(corpus, lambda c: newline_ranges(c, F.lit(0), F.octet_length(c), soft, hard, overlap))
    for i, t in enumerate(TEXTS):
        assert got[i] == slow.ranges(t.encode(), soft, hard, overlap), i


def test_short_text_is_still_cut_at_its_last_inner_newline(spark):
    row = spark.createDataFrame([(bytearray(b"line\n" * 3),)], "content binary")
    for overlap, expected in [(0, [(0, 10), (10, 15)]), (5, [(0, 10), (5, 10), (10, 15)])]:
        got = row.select(newline_ranges(F.col("content"), F.lit(0), F.lit(15), overlap=overlap).alias("s")).first()
        assert [(x.start, x.end) for x in got.s] == expected


def test_cover_fills_every_gap(spark):
    row = spark.createDataFrame(
        [(bytearray(b"a\nbbbb\ncc\n"), [(2, 4), (7, 9)])],
        "content binary, groups array<struct<start:int,end:int>>",
    )
    got = row.select(cover(F.col("content"), F.col("groups")).alias("s")).first().s
    assert [(x.start, x.end) for x in got] == [(0, 2), (2, 4), (4, 7), (7, 9), (9, 10)]


def test_points_and_newlines(spark):
    row = spark.createDataFrame([(bytearray(b"line1\nline2\nline3"),)], "content binary")
    c = F.col("content")
    got = row.select(
        newlines_in(c, F.lit(0), F.lit(17)).alias("all"),
        *[point_row(c, F.lit(i)).alias(f"r{i}") for i in (0, 5, 6, 11)],
        *[point_col(c, F.lit(i)).alias(f"c{i}") for i in (0, 5, 6, 11)],
        nearest_newline(c, F.lit(3), F.lit(0), F.lit(17)).alias("a"),
        nearest_newline(c, F.lit(9), F.lit(0), F.lit(17)).alias("b"),
        nearest_newline(c, F.lit(5), F.lit(0), F.lit(5)).alias("none"),
    ).first()
    assert got["all"] == [5, 11]
    assert [(got[f"r{i}"], got[f"c{i}"]) for i in (0, 5, 6, 11)] == [(0, 0), (0, 5), (1, 0), (1, 5)]
    assert (got.a, got.b, got["none"]) == (6, 12, None)


def test_equally_close_newlines_give_the_earlier(spark):
    apart, even = bytearray(b"xxxxx\nxxxx\nxxxx\nxxx"), bytearray(b"xxxx\nxxxxx\nxx")
    cases = [(apart, 7, 0, 6), (apart, 8, 0, 11), (apart, 7, 8, 11), (apart, 12, 0, 11), (even, 7, 0, 5)]
    for data, target, lo, expected in cases:
        row = spark.createDataFrame([(data,)], "content binary")
        got = row.select(nearest_newline(F.col("content"), F.lit(target), F.lit(lo), F.lit(len(data))).alias("x"))
        assert got.first().x == expected


def test_whole_chunks_against_a_plain_reading(spark, make_files):
    files = make_files({f"f{i}.txt": t for i, t in enumerate(TEXTS)})
    found = {}
    for r in chunk_plaintext(files).collect():
        found.setdefault(r.path, []).append(r)
    for i, t in enumerate(TEXTS):
        data = t.encode()
        expected = slow.overlapped(data, slow.merged(slow.parts(data)))
        rows = sorted(found[f"f{i}.txt"], key=lambda r: r.end_bytes)
        assert [(r.start_bytes, r.end_bytes) for r in rows] == expected
        for r in rows:
            lo, hi = r.start_bytes, r.end_bytes
            assert r.chunk == data[lo:hi].decode("utf-8", "replace")
            assert (r.start_row, r.start_col) == slow.point(data, lo)
            assert (r.end_row, r.end_col) == slow.point(data, hi)
        # Without the repeated context the chunks are the file again.
        edges = [0, *[r.end_bytes for r in rows]]
        assert b"".join(data[a:b] for a, b in zip(edges, edges[1:])) == data
