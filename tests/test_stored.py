"""Stored vectors and postings: changes, compaction, pruning and early stop against fresh builds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import keyword as K
from lodestone.operators.vectors import vector_search
from lodestone.sources.postings_store import PostingsStore, part_of, part_of_word
from lodestone.sources.segments import Segments
from lodestone.sources.vector_index import VectorIndex

VECTORS = "id string, repo string, branch string, embedding array<float>"


def vector_rows(spark, named):
    return spark.createDataFrame(
        [(i, "r" if n % 3 else "s", "main", v) for n, (i, v) in enumerate(named.items())], VECTORS)


def clustered(seed, n, groups=20, width=24):
    chosen = np.random.default_rng(seed)
    centres = chosen.normal(size=(groups, width))
    return {f"v{seed}_{i:04}": [float(x) for x in centres[i % groups] + 0.4 * chosen.normal(size=width)] for i in range(n)}


@pytest.fixture
def vectors(spark, tmp_path):
    return VectorIndex(spark, str(tmp_path / "vectors"))


def scores(rows):
    return [(r.id, round(r.vector_score, 6)) for r in rows.collect()]


def plans(rows):
    return rows._jdf.queryExecution().toString()


def test_vector_index_finds_what_the_scan_finds(spark, vectors):
    named = clustered(1, 1500)
    rows = vector_rows(spark, named)
    vectors.build(rows)
    assert 1 <= vectors.probes() < 38
    asked = rows.where(F.substring("id", -2, 2) == "07")
    exact = {q.id: {r.id for r in vector_search(rows, q.embedding, 10).collect()} for q in asked.collect()[:5]}
    many = {}
    for r in vectors.search_many(asked, 10).collect():
        many.setdefault(r.query_id, set()).add(r.id)
    assert set(many) == {r.id for r in asked.collect()} and all(len(found) == 10 for found in many.values())
    hits = [len(exact[q] & many[q]) / 10 for q in exact]
    single = [len(exact[q] & {r.id for r in vectors.search(named[q], 10).collect()}) / 10 for q in exact]
    assert np.mean(hits) >= 0.95 and np.mean(single) >= 0.95
    everything = vectors.search(named["v1_0007"], 10, probes=10**6)
    assert scores(everything) == scores(vector_search(rows, named["v1_0007"], 10).select("id", "vector_score"))


def test_vector_search_reads_the_parts_it_needs(spark, vectors):
    vectors.build(vector_rows(spark, clustered(2, 900)), lists=16)
    from lodestone.sources.segments import of_parts

    plan = plans(vectors.rows().where(of_parts([3, 5])))
    assert "PartitionFilters: [part" in plan or "part#" in plan.split("PartitionFilters")[1][:80]
    files = vectors.rows().where(of_parts([3])).inputFiles()
    read = {f.split("part=")[1].split("/")[0] for f in vectors.rows().where(of_parts([3])).select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert files and read <= {"3", "-1"}


def test_vector_changes_and_compaction(spark, vectors):
    named = clustered(3, 400)
    vectors.build(vector_rows(spark, named), lists=8)
    chosen = random.Random(3)
    for step in range(6):
        fresh = {k: v for k, v in clustered(10 + step, 12).items()}
        again = {k: [x + 1.0 for x in named[k]] for k in chosen.sample(sorted(named), 5)}
        gone = chosen.sample(sorted(set(named) - set(again)), 7)
        vectors.insert(vector_rows(spark, {**fresh, **again}))
        vectors.delete(spark.createDataFrame([(g,) for g in gone] + [(None,), ("never",)], "id string"))
        named.update(fresh | again)
        for g in gone:
            del named[g]
        if step == 3:
            vectors.compact()
        if step == 4:
            vectors.compact(retrain=True)
    assert {r.id: r.embedding for r in vectors.rows().collect()} == {
        k: [float(np.float32(x)) for x in v] for k, v in named.items()}
    query = next(iter(named.values()))
    exact = vector_search(vector_rows(spark, named), query, 15).select("id", "vector_score")
    assert scores(vectors.search(query, 15, probes=10**6)) == scores(exact)
    assert [r.id for r in vectors.search_many(spark.createDataFrame([("q", query)], "id string, embedding array<float>"),
            15, probes=10**6).orderBy(F.col("vector_score").desc(), "id").collect()] == [r.id for r in exact.collect()]
    vectors.compact()
    assert vectors.segments.log()[0]["base"] and len(vectors.segments.log()) == 1


def test_vectors_without_direction_widths_and_scopes(spark, vectors):
    named = {"a": [1.0, 0.0], "b": [0.9, 0.1], "zero": [0.0, 0.0], "none": None, "nan": [float("nan"), 1.0], "wide": [1.0, 0.0, 0.0], "hole": [None, 1.0]}
    rows = vector_rows(spark, named).unionByName(vector_rows(spark, {"x": [1.0, 0.0]}).withColumn("id", F.lit(None).cast("string")))
    vectors.build(rows)
    assert {r.id for r in vectors.rows().collect()} == set(named)
    assert {r.id for r in vectors.search([1, 0], 10).collect()} == {"a", "b"}
    assert [r.id for r in vectors.search([1, 0], 10, repo="r").collect()] == ["b"]
    assert [r.id for r in vectors.search([1, 0, 0], 10).collect()] == ["wide"]
    found = vectors.search_many(rows.where("id is not null"), 5).collect()
    assert {(r.query_id, r.id) for r in found} == {("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"), ("wide", "wide")}
    vectors.build(vector_rows(spark, named).where("false"))
    assert vectors.search([1, 0], 3).count() == 0 and vectors.search_many(rows, 3).count() == 0


def test_a_part_that_holds_most_rows(spark, vectors):
    same = {f"s{i:04}": [1.0, 2.0, 3.0] for i in range(3000)} | {k: v[:3] for k, v in clustered(5, 200).items()}
    vectors.build(vector_rows(spark, same))
    found = vectors.search_many(vector_rows(spark, {"q": [1.0, 2.0, 3.0], "p": [2.0, 4.0, 6.0]}), 7).collect()
    assert {q: sorted(r.id for r in found if r.query_id == q) for q in "pq"} == {q: [f"s{i:04}" for i in range(7)] for q in "pq"}


# --- postings ----------------------------------------------------------------------

CHUNKS = "id string, repo string, branch string, path string, chunk string"


def chunk_rows(spark, named):
    return spark.createDataFrame([(i, "s" if hash(i) % 3 == 0 else "r", "main", "p", t) for i, t in named.items()], CHUNKS)


def some_texts(seed, n):
    chosen = random.Random(seed)
    words = ["common", "the", "rare", "word", "blue", "Éclair", "42"] + [f"w{i}" for i in range(40)]
    weights = [30, 30, 1, 8, 4, 2, 3] + [1] * 40
    return {f"t{seed}_{i}": " ".join(chosen.choices(words, weights, k=chosen.randrange(0, 60))) for i in range(n)}


@pytest.fixture
def store(spark, tmp_path):
    return PostingsStore(spark, str(tmp_path / "words"), buckets=8, range_size=16)


QUERIES = ["blue the rare", "the_common eclair", "missing", "word word 42"]


def plain_scores(rows, query):
    return {r.id: r.keyword_score for r in K.bm25_scores(rows, query).select("id", "keyword_score").collect()}


def same_as_fresh(store, rows, queries=QUERIES, limit=12):
    for query in queries:
        want = plain_scores(rows, query)
        assert {r.id: r.keyword_score for r in store.scores(query).collect()} == pytest.approx(want)
        found = store.top(query, limit)
        best = sorted(want.items(), key=lambda p: (-round(p[1], 9), p[0]))[:limit]
        got = sorted(((r.id, r.keyword_score) for r in found.rows.collect()), key=lambda p: (-round(p[1], 9), p[0]))
        assert [s for _, s in got] == pytest.approx([s for _, s in best])
        assert all(want[i] == pytest.approx(s) for i, s in got)
        assert 0 <= found.scored <= found.blocks


def test_postings_after_random_batches_equal_a_fresh_build(spark, store):
    chosen = random.Random(8)
    named = some_texts(0, 120)
    store.commit(chunk_rows(spark, named))
    for step in range(1, 21):  # every batch is a delta of its own
        fresh = some_texts(step, chosen.randrange(4))
        again = {k: "rare " + named[k][::2] for k in chosen.sample(sorted(named), 2)}
        gone = [] if step % 4 == 0 else chosen.sample(sorted(set(named) - set(again)), 3)
        store.commit(chunk_rows(spark, {**fresh, **again}),
                     spark.createDataFrame([(g,) for g in gone] + [("never",)], "id string") if step % 3 else None)
        named.update(fresh | again)
        if step % 3:
            for g in gone:
                del named[g]
        if step == 13:
            store.compact()
    rows = chunk_rows(spark, named)
    stats = store.stats().first()
    assert stats == K.corpus_stats(rows).first()
    same_as_fresh(store, rows)
    live = {(r.id, r.term): list(r.positions) for r in store.read().collect()}
    assert live == {(r.id, r.term): list(r.positions) for r in K.postings(rows).collect()}
    store.compact()
    assert len(store.segments.log()) == 1 and store.stats().first() == stats
    same_as_fresh(store, rows, QUERIES[:1])


def test_the_part_of_a_word_is_the_same_on_the_driver(spark):
    words = ["common", "", "é漢", "x" * 100, "42"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", part_of(F.col("w"), 64).alias("p")).collect()
    assert {r.w: r.p for r in rows} == {w: part_of_word(w, 64) for w in words}


def test_a_query_opens_the_part_of_its_word_and_the_deltas(spark, store):
    store.commit(chunk_rows(spark, some_texts(1, 200)))
    store.commit(chunk_rows(spark, {"new": "common fresh"}))
    rows = store.read(["rare"])
    assert "PartitionFilters" in plans(rows) and "PushedFilters" in plans(rows)
    read = {f.split("part=")[1].split("/")[0] for f in
            (r.f for r in store._words(["rare"], store.segments.log()).select(F.input_file_name().alias("f")).distinct().collect())}
    assert len(read - {"-1"}) <= 1


def test_a_commit_writes_in_proportion_to_its_texts(spark, store, tmp_path):
    store.commit(chunk_rows(spark, some_texts(2, 1500)))
    store.commit(chunk_rows(spark, {"one": "a single short text"}), spark.createDataFrame([("t2_5",)], "id string"))
    size = lambda s: sum(f.stat().st_size for f in (tmp_path / "words").rglob("*.parquet") if f"segment={s}" in str(f))
    assert size(2) < 20_000 < size(1) / 3


def test_early_stop_skips_blocks_and_keeps_the_rows(spark, tmp_path):
    store = PostingsStore(spark, str(tmp_path / "w"), buckets=4, range_size=8)
    named = {f"d{i:04}": ("filler " * (5 + i % 97) + "common " * (1 + (i % 11 == 0) * 6)) for i in range(1200)}
    store.commit(chunk_rows(spark, named))
    found = store.top("common", 10)
    want = sorted(plain_scores(chunk_rows(spark, named), "common").items(), key=lambda p: (-round(p[1], 9), p[0]))[:10]
    assert [(r.id, round(r.keyword_score, 9)) for r in found.rows.collect()] == [(i, round(s, 9)) for i, s in want]
    assert found.blocks > 100 and found.scored < found.blocks / 2
    scoped = store.top("common", 5, repo="s")
    assert {r.id for r in scoped.rows.collect()} <= {i for i in named if hash(i) % 3 == 0} and scoped.rows.count() == 5


def test_empty_stores_and_texts(spark, store):
    assert store.scores("x").count() == 0 and store.top("x", 3).rows.count() == 0
    store.commit(chunk_rows(spark, {"a": "", "b": "..."}))
    assert store.stats().first() == (2.0, 1.0) and store.top("x", 3).rows.count() == 0
    store.commit(chunk_rows(spark, {}), spark.createDataFrame([("a",)], "id string"))
    store.commit(chunk_rows(spark, {"b": "x"}))
    assert store.stats().first() == (1.0, 2.0) and [r.id for r in store.top("x", 3).rows.collect()] == ["b"]


# --- segments ------------------------------------------------------------------------

def test_an_unfinished_segment_is_never_read(spark, tmp_path):
    parts = Segments(spark, str(tmp_path / "s"), {"t": "id string"})
    rows = lambda *ids: spark.createDataFrame([(i, 0) for i in ids], "id string, part int")
    parts.write("t", 1, rows("a", "b"))
    assert parts.read("t").count() == 0
    parts.commit(1, base=True)
    parts.write("t", 2, rows("lost", "files"))
    assert [r.id for r in parts.read("t").orderBy("id").collect()] == ["a", "b"]
    assert parts.next_number() == 2
    parts.write("t", 2, rows("c"))
    parts.commit(2, base=False)
    assert [r.id for r in parts.read("t").orderBy("id").collect()] == ["a", "b", "c"]
    parts.write("t", 3, rows("d"))
    parts.commit(3, base=True)
    assert [r.id for r in parts.read("t").collect()] == ["d"]
    parts.vacuum()
    assert sorted(p.name for p in (tmp_path / "s" / "t").iterdir()) == ["segment=3"]


def test_postings_are_moved_once(spark, tmp_path, monkeypatch):
    plans, write = {}, Segments.write
    def noted(self, name, number, rows, *order, **more):
        plans[name] = rows._jdf.queryExecution().optimizedPlan().toString()
        write(self, name, number, rows, *order, **more)
    monkeypatch.setattr(Segments, "write", noted)
    store = PostingsStore(spark, str(tmp_path / "w"), buckets=4, range_size=8)
    store.commit(chunk_rows(spark, some_texts(9, 60)))
    for name in ("words", "docs"):
        aggregate = plans[name].index("Aggregate")
        # One deal below the grouping, which it serves, and none above it.
        assert plans[name].count("Repartition") == 1 and plans[name].index("Repartition") > aggregate
        assert "RebalancePartitions" not in plans[name]


def test_blocks_are_made_by_range(monkeypatch):
    import pyarrow as pa

    from lodestone.sources import postings_store as P

    chosen = random.Random(15)
    texts = [(i % 5, None if i == 7 else f"c{i:02}", chosen.choices(["straße", "b", "a", "z9", f"own{i}"], k=1 + i % 9)) for i in range(40)]
    texts.append((2, "long", ["b"] * 70_000 + [f"w{i}" for i in range(70_000)]))
    chunks = [[{"id": i, "repo": "r", "branch": None, "length": len(w), "tokens": " ".join(w)} for at, i, w in texts if at == place] for place in range(5)]
    expected = {}
    for at, i, w in texts:
        for k, x in enumerate(w):
            expected.setdefault((x, at, i), (len(w), []))[1].append(k)
    kind = pa.list_(pa.struct([("id", pa.string()), ("repo", pa.string()), ("branch", pa.string()), ("length", pa.int32()), ("tokens", pa.string())]))
    batches = [pa.record_batch({"range": pa.array(some, pa.int32()), "chunks": pa.array([chunks[i] for i in some], kind)}) for some in ([3, 0, 2], [4, 1], [])]
    for at_once, in_batch in ((1 << 20, 1 << 15), (1, 300), (30, 4000)):
        monkeypatch.setattr(P, "WORDS_AT_ONCE", at_once)
        monkeypatch.setattr(P, "POSTINGS_PER_BATCH", in_batch)
        rows = [r for b in P._range_words(iter(batches)) for r in b.to_pylist()]
        found = {(r["term"], r["range"]): r for r in rows}
        assert len(found) == len(rows) and all(r["n"] == len(r["entries"]) and r["dead"] == 0 for r in rows)
        assert {(t, at, e["id"]): (e["length"], e["positions"]) for (t, at), r in found.items() for e in r["entries"]} == expected
        for r in rows:
            assert [e["id"] or "" for e in r["entries"]] == sorted(e["id"] or "" for e in r["entries"])
            pairs = {(e["tf"], e["length"]) for e in r["entries"]}
            best = [p for p in pairs if not any(q != p and q[0] >= p[0] and q[1] <= p[1] for q in pairs)]
            assert [(p["tf"], p["length"]) for p in r["peaks"]] == sorted(best, key=lambda p: p[1])


def test_rows_under_one_id_and_without_words_count_as_before(spark, tmp_path):
    rows = spark.createDataFrame([
        ("a", "r", "m", "x y"), ("a", "r", "m", "x z"), ("b", "r", "m", "--"), ("b", "r", "m", ""), ("c", "r", "m", None),
        (None, "r", "m", "x"), (None, "r", "m", ""), ("d", "r", "m", "y y y"),
    ], "id string, repo string, branch string, chunk string")
    store = PostingsStore(spark, str(tmp_path / "w"), buckets=4, range_size=8)
    store.commit(rows)
    # One for a, two for b, one for c, one for d, and for rows without an id one with words and both again.
    assert store.segments.log()[0]["facts"]["docs"] == 8 and store.segments.log()[0]["facts"]["words"] == 2 + 3 + 1
    docs = store.segments.read("docs")
    assert sorted(docs.where("id = 'a'").first()["terms"]) == ["x", "x", "y", "z"]
    assert {(r.id, r.term, r.tf) for r in store.read().collect()} == {
        ("a", "x", 1), ("a", "y", 1), ("a", "z", 1), (None, "x", 1), ("d", "y", 3)}


def test_pairs_of_blocks_are_read_where_they_lie():
    import tracemalloc

    import pyarrow as pa

    from lodestone.operators.vectors import _block_tops

    data = np.eye(64).repeat(16, axis=0).tobytes()
    ids = [f"v{i:04}" for i in range(1024)]
    batch = pa.RecordBatch.from_pydict({
        "ids": [ids] * 24, "width": pa.array([64] * 24, pa.int32()), "data": [data] * 24,
        "query_ids": [["q"]] * 24, "query_width": pa.array([64] * 24, pa.int32()), "query_data": [data[:512]] * 24,
    })
    tracemalloc.start()
    found = [r for out in _block_tops([batch], 3) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["id"] for r in found] == ["v0000", "v0001", "v0002"] * 24 and {r["vector_score"] for r in found} == {1.0}
    assert peak < 4 << 20 < 24 * len(data)


def test_compaction_moves_words_of_chunks_and_no_postings(spark, tmp_path, monkeypatch):
    plans, write = {}, Segments.write
    def noted(self, name, number, rows, *order, **more):
        plans[name] = rows._jdf.queryExecution().optimizedPlan().toString()
        write(self, name, number, rows, *order, **more)
    store = PostingsStore(spark, str(tmp_path / "w"), buckets=4, range_size=8)
    named = some_texts(11, 80)
    store.commit(chunk_rows(spark, named))
    store.commit(chunk_rows(spark, {"t11_3": "blue word"}), spark.createDataFrame([("t11_5",)], "id string"))
    before = {(r.id, r.term): (r.repo, list(r.positions)) for r in store.read().collect()}
    stats = store.stats().first()
    monkeypatch.setattr(Segments, "write", noted)
    store.compact()
    # One move of the rows of words to their range, and none of the rows that live.
    assert plans["words"].count("Repartition") == 1 and "entries" not in plans["words"].split("Repartition")[1]
    assert "Repartition" not in plans["texts"] + plans["docs"] and "RebalancePartitions" not in plans["docs"]
    assert {(r.id, r.term): (r.repo, list(r.positions)) for r in store.read().collect()} == before
    assert store.stats().first() == stats and {r.part for r in store.segments.read("docs").collect()} <= {0, 1, 2, 3}


def test_a_store_of_the_former_version_is_compacted(spark, tmp_path):
    import shutil

    store = PostingsStore(spark, str(tmp_path / "w"), buckets=4, range_size=8)
    named = some_texts(12, 60) | {"empty": "--"}
    store.commit(chunk_rows(spark, named))
    shutil.rmtree(tmp_path / "w" / "texts")  # it kept no rows of words
    store.commit(chunk_rows(spark, {"t12_3": "blue word"}), spark.createDataFrame([("t12_5",)], "id string"))
    named["t12_3"] = "blue word"
    del named["t12_5"]
    store.compact()
    same_as_fresh(store, chunk_rows(spark, named))
    live = {(r.id, r.term): list(r.positions) for r in store.read().collect()}
    assert live == {(r.id, r.term): list(r.positions) for r in K.postings(chunk_rows(spark, named)).collect()}


def test_more_keys_than_tasks_hold_are_joined_as_they_are(spark, store, monkeypatch):
    from lodestone.plans import checkpoint

    monkeypatch.setattr(checkpoint, "NAMED_KEYS", 0)
    named = some_texts(13, 40)
    store.commit(chunk_rows(spark, named))
    store.commit(chunk_rows(spark, {"t13_3": "blue word"}), spark.createDataFrame([("t13_5",)], "id string"))
    named["t13_3"] = "blue word"
    del named["t13_5"]
    store.compact()
    same_as_fresh(store, chunk_rows(spark, named))
