"""Retrieval of many lines at once against one line after the other."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import keyword as K
from lodestone.operators.embed import HashingModel
from lodestone.operators.rerank import lexical_reranker
from lodestone.plans.batch_retrieval import lexical_pairs, like_many, phrases_column, retrieve_many
from lodestone.plans.retrieval import retrieve
from lodestone.functions.analysis import query_phrases
from lodestone.sources.postings_store import PostingsStore

DIM = 16
ROWS = "id string, repo string, branch string, path string, language string, chunk string, embedding array<float>"
LINES = {
    "a": "common rare", "b": "the_common word3", "c": "  ", "d": None, "e": "ommo", "f": "common common the_the", "g": "100%_x", "h": "Rare!",
    "i": "nothing_here at all", "j": "w_3",
}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    chosen = random.Random(11)
    words = ["common", "the", "rare", "word3", "Word4", "at", "ALL", "100%_x"]
    texts = [" ".join(chosen.choices(words, [9, 9, 1, 2, 3, 2, 1, 1], k=chosen.randrange(0, 25))) for _ in range(90)]
    vectors = HashingModel(DIM).embed(texts).tolist()
    rows = spark.createDataFrame([
        (f"c{i:03}", "r" if i % 4 else "s", "main", f"p{i}", "text", t, v if i % 9 else None)
        for i, (t, v) in enumerate(zip(texts, vectors, strict=True))], ROWS)
    store = PostingsStore(spark, str(tmp_path_factory.mktemp("words")), buckets=4)
    store.commit(rows)
    return rows, store


def lines(spark):
    return spark.createDataFrame(list(LINES.items()), "query_id string, query string")


@pytest.mark.parametrize("options,reranked", [({}, False), ({"repo": "s"}, False), ({}, True)])
def test_many_lines_find_what_each_finds(spark, corpus, options, reranked):
    rows, store = corpus
    found = retrieve_many(rows, lines(spark), store, top_k=5, model=HashingModel(DIM), dim=DIM,
                          reranker=lexical_pairs if reranked else None, **options)
    got = {}
    for r in found.orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.score, 9)))
    for key, line in LINES.items():
        one = retrieve(rows, line, top_k=5, model=HashingModel(DIM), dim=DIM,
                       reranker=lexical_reranker if reranked else None, **options)
        assert got.get(key, []) == [(r.id, round(r.score, 9)) for r in one.collect()], line


def test_phrases_of_a_column(spark):
    rows = lines(spark).select("query", phrases_column(F.col("query")).alias("p")).collect()
    assert all((r.p or []) == query_phrases(r.query) for r in rows)


def test_substrings_go_in_blocks(spark, corpus, monkeypatch):
    rows, _ = corpus
    monkeypatch.setattr("lodestone.plans.batch_retrieval.LIKE_BLOCK", 3)
    asked = lines(spark).where("trim(query) <> ''")
    found = {}
    for r in like_many(rows, asked, 4).collect():
        found.setdefault(r.query_id, []).append(r.id)
    for key, line in LINES.items():
        if line and line.strip():
            want = K.top_by(K.like(rows, line), "keyword_score", 4).collect()
            assert sorted(found.get(key, [])) == sorted(r.id for r in want)
    assert like_many(rows, asked.where("false"), 4).count() == 0
