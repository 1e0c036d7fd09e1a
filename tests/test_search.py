import math
import random
import re
import sys
import time

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lodestone.config import SearchSettings, first_stage_limit
from lodestone.functions import vector as V
from lodestone.operators import keyword as K
from lodestone.operators.embed import (
    FirstWorking,
    HashingModel,
    embed_query,
    error_reports,
    with_embeddings,
)
from lodestone.operators.fusion import rrf, search_rrf, search_weighted
from lodestone.operators.rerank import lexical_reranker, model_reranker
from lodestone.operators.vectors import vector_search_many
from lodestone.plans.retrieval import as_chunks, retrieve, search_code

# The models below live in this file, which workers cannot import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXTS = {
    "a": "The quick brown fox. foo_bar baz",
    "b": "foo bar foo-bar; Fóo BAR",
    "c": "quick quick quick",
    "d": "bar foo and the rest of a longer text with many more words in it",
    "e": "nothing",
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (i, "r1" if i < "d" else "r2", "main", f"{i}.txt", "text", t, [float(n == k) for k in range(4)])
        for n, (i, t) in enumerate(TEXTS.items())
    ]
    kind = "id string, repo string, branch string, path string, language string, chunk string, embedding array<float>"
    return spark.createDataFrame(data, kind).cache()


def bm25_by_hand(query, id_words=1):
    fold = str.maketrans("óÓ", "oo")
    tokens = {i: re.findall(r"[^\W_]+", t.lower().translate(fold)) for i, t in TEXTS.items()}
    phrases = [[w for w in p.lower().split("_") if w] for p in re.findall(r"\w+", query)]
    mean = sum(len(t) + id_words for t in tokens.values()) / len(tokens)
    out = {}
    for p in phrases:
        tf = {i: sum(t[k:k + len(p)] == p for k in range(len(t))) for i, t in tokens.items()}
        n = sum(f > 0 for f in tf.values())
        idf = max(math.log((len(tokens) - n + 0.5) / (n + 0.5)), 1e-6)
        for i, f in tf.items():
            if f:
                length = len(tokens[i]) + id_words
                out[i] = out.get(i, 0) + idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * length / mean))
    return out


@pytest.mark.parametrize("query", ["quick", "foo_bar", "quick fox quick", "bar foo_bar nothing", "missing"])
def test_bm25_and_postings_by_hand(rows, query):
    expected = bm25_by_hand(query)
    got = {r.id: r.keyword_score for r in K.bm25(rows, query).collect()}
    stored = {
        r.id: r.keyword_score
        for r in K.bm25_postings(K.postings(rows), K.corpus_stats(rows), query).collect()
    }
    assert got == pytest.approx(expected) and stored == pytest.approx(expected)


def test_keyword_search_filters_and_falls_back(rows):
    assert [r.id for r in K.keyword_search(rows, "quick", 5, repo="r1").collect()] == ["c", "a"]
    assert K.keyword_search(rows, "quick", 5, repo="r2").collect() == []
    assert [r.id for r in K.keyword_search(rows, "uick", 5).collect()] == ["a", "c"]
    assert [r.id for r in K.keyword_search(rows, "q_ick", 5).collect()] == ["a", "c"]
    assert len(K.keyword_search(rows, "", 3).collect()) == 3
    assert len(K.keyword_search(rows, "%", 9).collect()) == 5


def test_cosine_guards(rows, spark):
    got = {r.id: r.vector_score for r in rows.withColumn("vector_score", V.cosine_to(F.col("embedding"), [0, 3, 0, 0])).collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 0.0, "d": 0.0, "e": 0.0}
    for query in ([], [0.0] * 4, [1.0] * 3):
        assert {r[0] for r in rows.select(V.cosine_to(F.col("embedding"), query)).collect()} == {0.0}
    pairs = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0], [1.0]), ([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in pairs.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [0.8, 0.0, 0.0]


def test_rank_fusion_by_hand(spark):
    kw = spark.createDataFrame([("A", 2.0), ("B", 1.0)], "id string, keyword_score double")
    vec = spark.createDataFrame([("A", 0.1), ("B", 0.9), ("C", 0.5)], "id string, vector_score double")
    got = [(r.id, round(r.score, 7)) for r in rrf(kw, vec, 10).orderBy(F.col("score").desc()).collect()]
    assert got == [("B", 0.0330601), ("A", 0.0327957), ("C", 0.0325225)]


def test_word_only_candidates_outrank_negative_cosines(spark):
    kw = spark.createDataFrame([("W", 2.0)], "id string, keyword_score double")
    vec = spark.createDataFrame([("N", -0.5)], "id string, vector_score double")
    ranks = {r.id: (r.keyword_rank, r.vector_rank) for r in rrf(kw, vec, 10).collect()}
    assert ranks == {"W": (0, 0), "N": (1, 1)}


def test_weighted_search_and_its_empty_query(rows):
    lexed = rows.withColumn("lexemes", F.split(F.lower("chunk"), "[^a-z]+"))
    found = search_weighted(lexed, [0, 1, 0, 0], "quick", 2).collect()
    assert [r.id for r in found] == ["b", "c"]
    assert found[1].score == pytest.approx(0.3 * 0.3)
    empty = search_weighted(lexed, [0, 1, 0, 0], " ", 1).first()
    assert (empty.id, empty.keyword_score) == ("b", 0.0)


def test_web_queries():
    assert K.web_query('the "running dogs" or -cats fish') == [[(["run", "dog"], False)], [(["cat"], True), (["fish"], False)]]
    assert K.web_query("the of") == []
    query = K.web_query("x y", english=False)
    assert K.cover_density("x a y b x y".split(), query) == pytest.approx(0.1 / 2 + 0.1 / 2 + 0.1)
    assert K.cover_density(["x"], query) == 0.0
    phrase = K.web_query('"a b"', english=False)
    assert K.cover_density("a b a b".split(), phrase) == pytest.approx(0.2)


def plain_cover(row, query):
    """The same by its definition: from each start on, the first end and then the last begin that satisfy the query."""
    wanted = [[tuple(s) for s, excluded in a if not excluded] for a in query]
    spans = sorted({(i, i + len(s) - 1, s) for a in wanted for s in a for i in range(len(row) - len(s) + 1)
                    if all(not w or row[i + k] == w for k, w in enumerate(s))})
    places = {lo + k for lo, _, s in spans for k, w in enumerate(s) if w}

    def holds(lo, hi):
        inside = {s for a, b, s in spans if lo <= a and b <= hi}
        return any(a and set(a) <= inside for a in wanted)

    total, lo = 0.0, 0
    while True:
        hi = next((h for h in range(lo, len(row)) if holds(lo, h)), None)
        if hi is None:
            return total
        begin = next(b for b in range(hi, -1, -1) if holds(b, hi))
        total += 0.1 / (1 + (hi - begin) - (sum(begin <= p <= hi for p in places) - 1))
        lo = begin + 1


@pytest.mark.parametrize("seed", range(60))
def test_cover_density_is_its_definition(seed):
    chosen = random.Random(seed)
    row = [chosen.choice(["a", "b", "c", "of", "", "x", "y"]) for _ in range(chosen.randrange(40))]
    lines = ["a b", '"a b" c', "a or b c", '"a of b" or "b c" -x', 'a "b a" y or c', "a a", '"of of"', '"of of" or of']
    query = K.web_query(chosen.choice(lines), english=False)
    assert K.cover_density(row, query) == pytest.approx(plain_cover(row, query))
    stopped = [[(["a", "", "b"], False), (["c"], False)], [(["x"], True), (["y"], False)]]
    assert K.cover_density(row, stopped) == pytest.approx(plain_cover(row, stopped))


def test_cover_density_takes_linear_time():
    query = K.web_query('a b or "a c"', english=False)
    times = []
    for n in (20_000, 80_000):
        row = ["a", "b", "c", "a"] * n
        began = time.perf_counter()
        K.cover_density(row, query)
        times.append(time.perf_counter() - began)
    assert times[1] < 12 * times[0]


def test_limits():
    assert (first_stage_limit(10), first_stage_limit(80), first_stage_limit(5, 20)) == (50, 80, 20)
    assert SearchSettings().candidates(0) == 5 and SearchSettings.limit("7") == 7


def test_retrieve_ranks_and_reranks(rows):
    assert retrieve(rows, "  ", query_vector=[1, 0, 0, 0]).collect() == []
    plain = [r.id for r in retrieve(rows, "quick", top_k=2, query_vector=[0, 0, 1, 0]).collect()]
    assert plain[0] == "c" and len(plain) == 2
    lexical = retrieve(rows, "nothing", top_k=2, query_vector=[1, 0, 0, 0], reranker=lexical_reranker)
    assert lexical.first().id == "e"


def longest_first():
    return lambda query, texts: [len(t) for t in texts]


def wrong_count():
    return lambda query, texts: [0.0]


def test_model_reranker(rows):
    best = retrieve(rows, "quick", top_k=1, query_vector=[1, 0, 0, 0], reranker=model_reranker(longest_first))
    assert best.first().id == "d"
    broken = retrieve(rows, "quick", top_k=1, query_vector=[1, 0, 0, 0], reranker=model_reranker(wrong_count))
    with pytest.raises(Exception, match="reranker gave 1 scores"):
        broken.collect()


def test_search_tool(rows):
    spots = rows.withColumns({c: F.lit(0) for c in ("start_row", "start_col", "end_row", "end_col", "start_bytes", "end_bytes")})
    got = search_code(spots, "quick", top_k=2, query_vector=[0, 0, 1, 0])
    assert [r["id"] for r in got["results"]] == ["c", "a"]
    first = got["results"][0]
    assert first["embeddings"] is None and "embedding" not in first
    assert first["formatted"] == '<file path="c.txt" repo="r1" branch="main">\nquick quick quick\n</file>'
    assert first["end_bytes"] == len("quick quick quick")
    assert got["markdown"].startswith("### c.txt\n\n```text\nquick quick quick\n```\n\n### a.txt")


def test_hits_get_defaults(spark):
    kind = "chunk string, repo string, path string, language string, start_row int, start_col int, end_row int, end_col int, start_bytes int, end_bytes int"
    row = as_chunks(spark.createDataFrame([("é", None, None, None, None, 1, None, None, None, None)], kind)).first()
    assert (row.repo, row.language, row.start_row, row.start_col, row.end_bytes) == ("", "unknown", 0, 1, 2)


def failing():
    raise OSError("no such backend")


def picky():
    def embed(texts):
        if any(t == "bad" for t in texts):
            raise ValueError("cannot embed")
        return np.ones((len(texts), 4))

    return embed


def test_embedding_failures_cost_their_batch_only(spark):
    data = [(t, f"{i}.txt", "s", 0, 0, 1, 1) for i, t in enumerate(["x", "y", "bad", "z"])]
    chunks = spark.createDataFrame(
        data, "chunk string, path string, signature string, start_row int, start_col int, end_row int, end_col int"
    ).coalesce(1)
    done = with_embeddings(chunks, picky, dim=4, batch=2)
    assert [r.path for r in done.where("error is null").collect()] == ["0.txt", "1.txt"]
    assert {(r.path, r.message) for r in error_reports(done).collect()} == {("2.txt", "cannot embed"), ("3.txt", "cannot embed")}
    wide = with_embeddings(chunks, picky, dim=5).first()
    assert wide.embedding is None


def test_wrong_width_is_reported(spark):
    chunks = spark.createDataFrame([("x",)], "chunk string")
    row = with_embeddings(chunks, HashingModel(8), dim=9).first()
    assert row.embedding is None and "expected width 9" in row.error
    with pytest.raises(ValueError, match="expected 9"):
        embed_query("x", HashingModel(8), dim=9)


def test_models_fall_back_and_give_unit_vectors():
    model = FirstWorking((failing, HashingModel(16)))()
    assert np.linalg.norm(model(["some words here"])[0]) == pytest.approx(1.0)
    with pytest.raises(RuntimeError, match="no such backend"):
        FirstWorking((failing,))()


def test_hybrid_search_over_hashed_vectors(rows):
    embedded = with_embeddings(rows.drop("embedding"), HashingModel(64), dim=64)
    found = search_rrf(embedded, embed_query("quick fox", HashingModel(64), dim=64, prefix=""), "quick fox", 3)
    assert {r.id for r in found.limit(2).collect()} == {"a", "c"}


def test_many_queries_find_what_one_by_one_finds(spark):
    import numpy as np

    chosen = np.random.default_rng(3)
    rows = [(f"{i:03}", chosen.normal(size=6).tolist()) for i in range(300)]
    rows += [("n", None), ("e", []), ("z", [0.0] * 6), ("w", [1.0] * 4), ("d", rows[7][1])]
    table = spark.createDataFrame(rows, "id string, embedding array<float>")
    queries = table.where("id < '040' or id in ('n', 'z', 'w')")
    found = {}
    for r in vector_search_many(table, queries, 5).collect():
        found.setdefault(r.query_id, []).append((-round(r.vector_score, 6), r.id))
    units = {k: np.float32(v) / np.linalg.norm(np.float32(v)) for k, v in rows if v and any(v)}
    assert set(found) == {k for k in units if k < "040"} | {"w"}
    for key, got in found.items():
        want = sorted((-round(float(units[key] @ v), 6), k) for k, v in units.items() if len(v) == len(units[key]))[:5]
        assert [k for _, k in sorted(got)] == [k for _, k in want]
    assert vector_search_many(table, table.where("false"), 5).count() == 0
