import random
import subprocess

import pytest
from pyspark.sql import functions as F

from lodestone import schema as S
from lodestone.operators import keyword as K
from lodestone.operators.chunk import chunk_files, chunk_plaintext
from lodestone.operators.embed import HashingModel, with_embeddings
from lodestone.operators.fusion import search_rrf, search_weighted
from lodestone.plans.catalog import MarkedFails
from lodestone.plans.indexing import index_changes
from lodestone.plans.retrieval import retrieve
from lodestone.sources.files import files_from_directory
from lodestone.sources.git import GitChanges, git_changes, resolve_range
from lodestone.sources.index_table import IndexTable, index_rows
from lodestone.sources.postings_store import PostingsStore
from lodestone.sources.registry import (
    StoreConfig,
    get_store,
    jdbc_url,
    open_store,
    register_store,
    stores,
    unregister_store,
)
from lodestone.sources.segments import Segments
from lodestone.streaming.delta import TIMEOUT_EXIT_CODE, LastChanges, finish, index_stream, merge_batch

DIM = 32
COUNTER = iter(range(1000))


@pytest.fixture
def table(spark):
    made = IndexTable(spark, StoreConfig(table=f"chunks_{next(COUNTER)}"), buckets=4)
    yield made
    made.drop()


@pytest.fixture
def embedded(make_files):
    def make(named, repo="repo", branch="main"):
        chunks = chunk_plaintext(make_files(named, repo, branch))
        return index_rows(with_embeddings(chunks, HashingModel(DIM), dim=DIM), DIM)

    return make


def paths(table):
    return sorted(r.path for r in table.read().select("path").distinct().collect())


def terms(table):
    return {r.term for r in table.read_postings().select("term").distinct().collect()}


def path_rows(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_rows_have_the_stored_columns(embedded):
    rows = embedded({"a.txt": "alpha beta"})
    assert rows.columns == S.INDEX.fieldNames() and rows.columns[:16] == S.INDEX_COLUMNS
    row = rows.first()
    assert (row.status, row.mutation_id, row.search_vector) == ("committed", None, row.chunk)
    assert len(row.embedding) == DIM


def test_upsert_replaces_by_id_and_keeps_the_rest(spark, table, embedded):
    table.upsert(embedded({"a.txt": "alpha beta", "b.txt": "gamma"}))
    table.upsert(embedded({"a.txt": "alpha BETA", "c.txt": "delta"}))
    got = {r.path: r.chunk for r in table.read().collect()}
    assert got == {"a.txt": "alpha BETA", "b.txt": "gamma", "c.txt": "delta"}
    assert terms(table) == {"alpha", "beta", "gamma", "delta"}
    twice = embedded({"z.txt": "one"}).withColumn("seq", F.lit(1)).unionByName(
        embedded({"z.txt": "one"}).withColumns({"seq": F.lit(2), "chunk": F.lit("two")})
    )
    table.upsert(twice, order="seq")
    assert [r.chunk for r in table.read().where("path = 'z.txt'").collect()] == ["two"]


def test_delete_empties_partitions_of_one_repository(spark, table, embedded):
    table.upsert(embedded({"a.txt": "alpha", "b.txt": "beta"}, repo="one"))
    table.upsert(embedded({"a.txt": "gamma"}, repo="it's", branch="dev"))
    table.delete(path_rows(spark), repo="one")
    table.delete(path_rows(spark, "a.txt", "missing.txt"), repo="one")
    assert sorted((r.repo, r.path) for r in table.read().collect()) == [("it's", "a.txt"), ("one", "b.txt")]
    assert terms(table) == {"beta", "gamma"}
    table.delete(path_rows(spark, "a.txt", "b.txt"))
    assert table.read().count() == 0 and table.read_postings().count() == 0
    assert table.indexed_paths("one").count() == 0


def test_missing_or_wrong_embeddings_fail(spark, table, embedded):
    rows = embedded({"a.txt": "alpha"})
    for bad, message in [(F.lit(None).cast("array<float>"), "without embedding"), (F.slice("embedding", 1, 3), "width")]:
        broken = index_rows(rows.withColumn("embedding", bad), DIM)
        with pytest.raises(Exception, match=message):
            broken.collect()


def test_bootstrap_twice_and_added_columns(spark):
    spark.sql("CREATE TABLE old_chunks (id string, path string, repo string, bucket int) USING parquet PARTITIONED BY (repo, bucket)")
    table = IndexTable(spark, StoreConfig(table="old_chunks"), buckets=4, keep_postings=False)
    again = IndexTable(spark, StoreConfig(table="old_chunks"), buckets=4, keep_postings=False)
    assert set(S.INDEX.fieldNames()) <= set(again.spark.table("old_chunks").columns)
    assert table.read().count() == 0
    spark.sql("DROP TABLE old_chunks")


def test_stored_postings_search_like_the_rows(table, embedded):
    table.upsert(embedded({f"{i}.txt": f"common word{i} " + "rare " * (i % 3) for i in range(12)}))
    for query in ("common", "rare word3", "common_word5"):
        stored = K.bm25_postings(table.read_postings(), table.stats(), query)
        direct = K.bm25(table.read(), query)
        expected = {r.id: r.keyword_score for r in direct.collect()}
        assert {r.id: r.keyword_score for r in stored.collect()} == pytest.approx(expected)
        vector = [1.0] * DIM
        by_index = table.search(table.read(), vector, query, 4).select("id", "score").collect()
        by_scan = search_rrf(table.read(), vector, query, 4).select("id", "score").collect()
        assert by_index == by_scan
    fallback = retrieve(table.read(), "ommo", top_k=3, query_vector=[1.0] * DIM, search=table.search)
    assert fallback.count() == 3
    weighted = search_weighted(table.read(), [1.0] * DIM, "commonly absent or rare", 12)
    assert weighted.where("keyword_score > 0").count() == 8


def test_store_registry(spark):
    assert "parquet" in stores() and get_store(" PARQUET ") is not None
    register_store(" Mine ", lambda spark, config: config.table)
    assert open_store(spark, StoreConfig("mine", "t")) == "t"
    unregister_store("MINE")
    with pytest.raises(ValueError, match="unknown store"):
        open_store(spark, StoreConfig("mine"))
    with pytest.raises(ValueError):
        register_store("  ", lambda: None)
    with pytest.raises(TypeError):
        register_store("x", "not callable")


def test_store_options():
    assert StoreConfig.from_options({}) == StoreConfig()
    assert StoreConfig.from_options({"provider": " Other ", "url": "u", "table": " "}).provider == "other"
    with pytest.raises(RuntimeError, match="needs a url"):
        StoreConfig.from_options({"provider": "other"})
    assert jdbc_url(" postgres://h/d ") == jdbc_url("postgresql://h/d") == "jdbc:postgresql://h/d"
    assert jdbc_url("jdbc:x") == "jdbc:x"


@pytest.fixture
def tree(tmp_path):
    def git(*args):
        done = subprocess.run(
            ["git", "-C", str(tmp_path), "-c", "user.name=n", "-c", "user.email=e@x", *args],
            check=True, capture_output=True, text=True,
        )
        return done.stdout.strip()

    def write(name, data):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data if isinstance(data, bytes) else data.encode())

    git("init", "-q")
    write("keep.py", "def keep():\n    return 1\n")
    write("delete.py", "def gone():\n    return 2\n")
    write("to_rename.py", "def moved():\n    return 3\n")
    write("skip.log", "noise\n")
    write("image.bin", b"\x89PNG\r\n\x1a\n" + b"\0" * 40)
    git("add", "-A")
    git("commit", "-q", "-m", "first")
    first = git("rev-parse", "HEAD")
    write("dir/né w.py", "def fresh():\n    return 4\n")
    (tmp_path / "delete.py").unlink()
    (tmp_path / "to_rename.py").rename(tmp_path / "renamed.py")
    write("skip.log", "more noise\n")
    git("add", "-A")
    git("commit", "-q", "-m", "second")
    return tmp_path, first, git("rev-parse", "HEAD")


def test_git_changes(spark, tree):
    root, first, second = tree
    got = {(r.path, r.op) for r in git_changes(spark, str(root), ignore="*.log").collect()}
    assert got == {("dir/né w.py", "A"), ("delete.py", "D"), ("to_rename.py", "D"), ("renamed.py", "A")}
    assert ("skip.log", "M") in {(r.path, r.op) for r in git_changes(spark, str(root), start=first, end=second).collect()}
    full = {(r.path, r.op) for r in git_changes(spark, str(root), full=True).collect()}
    assert ("keep.py", "A") in full and ("delete.py", "D") not in full
    assert git_changes(spark, str(root), start=second).collect() == []
    assert resolve_range(str(root)) == (first, second)


def test_single_commit_starts_from_nothing(spark, tmp_path):
    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=n", "-c", "user.email=e", *a], check=True, capture_output=True)
    run("init", "-q")
    (tmp_path / "only.py").write_text("x = 1\n")
    run("add", "-A")
    run("commit", "-q", "-m", "one")
    assert [(r.path, r.op) for r in git_changes(spark, str(tmp_path)).collect()] == [("only.py", "A")]
    with pytest.raises(RuntimeError, match="git diff failed"):
        from lodestone.sources.git import changed_paths

        list(changed_paths(str(tmp_path), "nowhere", "HEAD"))


def test_indexing_a_tree_in_two_runs(spark, table, tree):
    root, first, second = tree
    files = files_from_directory(spark, str(root), repo="repo", branch="main").where(~F.col("path").startswith(".git/"))
    options = {"repo": "repo", "ignore": "*.log", "model": HashingModel(DIM), "dim": DIM}
    table.upsert(index_rows(with_embeddings(
        chunk_files(spark.createDataFrame([("repo", "main", "delete.py", bytearray(b"def gone():\n  pass\n"))], S.FILES)),
        HashingModel(DIM), dim=DIM), DIM))
    report = index_changes(table, files, git_changes(spark, str(root)), **options)
    assert (report.processed_files, report.processed_chunks, report.deleted_files) == (2, 4, 2)
    assert paths(table) == ["dir/né w.py", "renamed.py"]
    report = index_changes(table, files, git_changes(spark, str(root), full=True), full=True, **options)
    assert report.skipped_binary == 1 and report.processed_files == 1
    assert paths(table) == ["dir/né w.py", "keep.py", "renamed.py"]
    found = retrieve(table.read(), "def fresh", top_k=1, model=HashingModel(DIM), dim=DIM)
    assert found.first().path == "dir/né w.py"


def test_modified_paths_lose_their_former_chunks(spark, table, make_files):
    options = {"repo": "repo", "model": HashingModel(DIM), "dim": DIM}
    change = spark.createDataFrame([("a.txt", "M")], S.CHANGES)
    index_changes(table, make_files({"a.txt": "long former text"}), change, **options)
    index_changes(table, make_files({"a.txt": "short"}), change, **options)
    assert [r.chunk for r in table.read().collect()] == ["short"]
    index_changes(table, make_files({"a.txt": "other length"}), change, keep_stale=True, **options)
    assert sorted(r.chunk for r in table.read().collect()) == ["other length", "short"]


def ends(table):
    return sorted((r.branch, r.path, r.end_bytes) for r in table.read().collect())


def test_a_branch_keeps_its_rows_when_another_is_indexed(spark, table, make_files):
    options = {"repo": "repo", "model": HashingModel(DIM), "dim": DIM}
    change = spark.createDataFrame([("x.txt", "M")], S.CHANGES)
    index_changes(table, make_files({"x.txt": "on main"}), change, **options)
    index_changes(table, make_files({"x.txt": "dev"}, branch="dev"), change, **options)
    assert ends(table) == [("dev", "x.txt", 3), ("main", "x.txt", 7)]
    gone = spark.createDataFrame([("main", "x.txt", "D")], "branch string, path string, op string")
    index_changes(table, make_files({"x.txt": ""}), gone, **options)
    assert ends(table) == [("dev", "x.txt", 3)]


def test_a_failing_model_leaves_what_was_indexed(spark, table, make_files):
    change = spark.createDataFrame([("a.txt", "M"), ("b.txt", "M")], S.CHANGES)
    options = {"repo": "repo", "dim": DIM, "batch": 1}
    index_changes(table, make_files({"a.txt": "old", "b.txt": "old"}), change, model=HashingModel(DIM), **options)
    files = make_files({"a.txt": "REFUSED text", "b.txt": "new text"})
    report = index_changes(table, files, change, model=MarkedFails("REFUSED", DIM), **options)
    assert ends(table) == [("main", "a.txt", 3), ("main", "b.txt", 8)]
    assert [r.path for r in report.errors.collect()] == ["a.txt"]


def test_a_stream_reports_failures_and_keeps_branches(spark, table):
    rows = [(1, "main", "a.txt", "A", b"old"), (2, "dev", "a.txt", "A", b"older")]
    merge = lambda rows, number: merge_batch(
        table, spark.createDataFrame([(*r[:4], bytearray(r[4])) for r in rows], STREAM),
        repo="repo", model=MarkedFails("REFUSED", DIM), dim=DIM, batch_id=number)
    assert merge(rows, 0).count() == 0
    for _ in range(2):
        assert [r.message for r in merge([(3, "main", "a.txt", "M", b"REFUSED text")], 1).collect()] == ["marked"]
    assert ends(table) == [("dev", "a.txt", 5), ("main", "a.txt", 3)]
    assert [(r.path, r.batch) for r in spark.table(f"{table.table}_errors").collect()] == [("a.txt", 1)]
    spark.sql(f"DROP TABLE {table.table}_errors")


def test_buckets_belong_to_the_table(spark, table, embedded):
    table.upsert(embedded({f"{i}.txt": "one" for i in range(3)}))
    with pytest.raises(ValueError, match="4 buckets"):
        IndexTable(spark, StoreConfig(table=table.table), buckets=64)
    again = IndexTable(spark, StoreConfig(table=table.table))
    again.upsert(embedded({f"{i}.txt": "two" for i in range(2)}))
    assert sorted(r.chunk for r in table.read().collect()) == ["one", "two", "two"]


def test_different_rows_under_one_id_need_an_order(table, embedded):
    rows = embedded({"z.txt": "one"})
    table.upsert(rows.unionByName(rows))
    assert table.read().count() == 1
    with pytest.raises(Exception, match="different rows under one id"):
        table.upsert(rows.unionByName(rows.withColumn("chunk", F.lit("two"))))


STEPS = [("_rewrite", IndexTable), ("commit", PostingsStore), ("commit", Segments), ("_forget", IndexTable)]


@pytest.mark.parametrize("name,where", STEPS)
def test_a_batch_cut_short_is_finished(spark, table, embedded, monkeypatch, name, where):
    """A batch stops before and right after a step; the next writer finds the table of an unbroken run."""
    first = embedded({"a.txt": "alpha old", "b.txt": "beta", "c.txt": "gamma"})
    second = embedded({"a.txt": "alpha new words", "d.txt": "delta"})
    table.upsert(first)
    whole = getattr(where, name)
    for after in (False, True):
        def stop(*args, **kwargs):
            if after:
                whole(*args, **kwargs)
            raise RuntimeError("lost")

        monkeypatch.setattr(where, name, stop)
        with pytest.raises(RuntimeError, match="lost"):
            table.replace_paths(second, path_rows(spark, "b.txt", "a.txt"), "repo")
        monkeypatch.setattr(where, name, whole)
        opened = IndexTable(spark, StoreConfig(table=table.table))
        opened.recover()
        finished = paths(opened) == ["a.txt", "c.txt", "d.txt"]
        assert finished or paths(opened) == ["a.txt", "b.txt", "c.txt"]
        live = {(r.path, t) for r in opened.read().collect() for t in r.chunk.lower().split()}
        by_id = {r.id: r.path for r in opened.read().collect()}
        assert {(by_id[r.id], r.term) for r in opened.read_postings().collect()} == live
        assert opened.store.stats().first() == opened.stats().first()
    table.replace_paths(second, path_rows(spark, "b.txt", "a.txt"), "repo")
    assert sorted(r.chunk for r in table.read().collect()) == ["alpha new words", "delta", "gamma"]
    assert terms(table) == {"alpha", "new", "words", "delta", "gamma"}


STREAM = "seq long, branch string, path string, op string, content binary"


def test_stream_equals_batch(spark, table, make_files, tmp_path):
    log = [
        (1, "main", "a.txt", "A", b"alpha one"), (2, "main", "b.txt", "A", b"beta"),
        (3, "main", "a.txt", "M", b"alpha two!"), (4, "main", "b.txt", "D", None), (5, "main", "c.txt", "A", b"gamma"),
        (6, "main", "d.txt", "T", b"ignored"),
    ]
    source, check = tmp_path / "log", tmp_path / "check"
    for k, part in enumerate([log[:3], log[3:]]):
        spark.createDataFrame([(*r[:4], None if r[4] is None else bytearray(r[4])) for r in part], STREAM).coalesce(1).write.mode("append").parquet(str(source))
        changes = spark.readStream.schema(STREAM).parquet(str(source))
        query = index_stream(changes, table, str(check), repo="repo", model=HashingModel(DIM), dim=DIM)
        assert finish(query) == 0
        assert paths(table) == (["a.txt", "b.txt"] if k == 0 else ["a.txt", "c.txt"])
    expected = chunk_files(make_files({"a.txt": "alpha two!", "c.txt": "gamma"}))
    assert sorted(r.id for r in table.read().collect()) == sorted(r.id for r in expected.collect())


@pytest.mark.parametrize("seed", range(2))
def test_changes_in_any_order_and_split(spark, table, seed):
    chosen = random.Random(seed)
    log = [(n, chosen.choice(["main", "dev"]), f"{chosen.choice('abc')}.txt", chosen.choice("AAMDT"), f"v{n} text".encode()) for n in range(24)]
    last = {}
    for n, branch, path, op, content in log:
        if op != "T":
            last[branch, path] = None if op == "D" else content.decode()
    chosen.shuffle(log)
    cuts = sorted(chosen.sample(range(1, 24), 3))
    parts = [log[a:b] for a, b in zip([0, *cuts], [*cuts, 24])]
    for part in [*parts, parts[chosen.randrange(4)]]:
        merge_batch(table, spark.createDataFrame([(*r[:4], bytearray(r[4])) for r in part], STREAM),
                    repo="repo", model=HashingModel(DIM), dim=DIM)
    if seed:
        LastChanges(table).compact()
        merge_batch(table, spark.createDataFrame([(-1, "main", "a.txt", "A", bytearray(b"older")), (None, "main", "b.txt", "A", bytearray(b"no number"))], STREAM),
                    repo="repo", model=HashingModel(DIM), dim=DIM)
    want = {k: v for k, v in last.items() if v is not None}
    seen = set(last)
    got = {(r.branch, r.path): r.chunk for r in table.read().collect()}
    assert {k: v for k, v in got.items() if k in seen} == want


def test_deadline_gives_the_retry_code():
    class Slow:
        stopped = False

        def awaitTermination(self, seconds):
            return False

        def stop(self):
            self.stopped = True

    query, ticks = Slow(), iter([0, 5, 11])
    assert finish(query, 10, lambda: next(ticks)) == TIMEOUT_EXIT_CODE and query.stopped


def test_git_stream_offsets_are_commits(spark, tree):
    root, first, second = tree
    reader = GitChanges({"root": str(root), "from": first}).simpleStreamReader(None)
    assert reader.initialOffset() == {"commit": first}
    rows, end = reader.read({"commit": first})
    assert end == {"commit": second} and ("renamed.py", "A") in list(rows)
    assert list(reader.readBetweenOffsets(end, end)) == []


def test_whole_rows_are_only_moved_for_ids_that_repeat(spark, table, monkeypatch):
    from lodestone.sources import index_table

    def moved(rows):
        raise AssertionError("no id repeats")

    files = spark.createDataFrame([("r", "main", f"f{i}.txt", f"text {i}".encode()) for i in range(5)], S.FILES)
    monkeypatch.setattr(index_table, "one_per_id", moved)
    index_changes(table, files, files.selectExpr("path", "'A' AS op"), repo="r", model=HashingModel(8), dim=8)
    assert table.read().count() == 5


def test_ids_are_left_out_where_rows_lie(spark, monkeypatch):
    from lodestone.plans import checkpoint
    from lodestone.sources.index_table import without_ids

    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5)], "id string, n int")
    gone = spark.createDataFrame([("b",), ("b",), ("x",), (None,)], "id string")
    for most in (1 << 21, 0):
        monkeypatch.setattr(checkpoint, "NAMED_KEYS", most)
        found = without_ids(rows, gone)
        assert sorted(r.n for r in found.collect()) == [1, 4, 5]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("_code" in plan) == (most > 0)


def test_only_rows_of_ids_that_repeat_are_moved(spark, table, monkeypatch):
    from lodestone.sources import index_table

    moved, once = [], index_table.one_per_id
    monkeypatch.setattr(index_table, "one_per_id", lambda rows: moved.append(rows) or once(rows))
    files = spark.createDataFrame([("r", "main", f"f{i}.txt", f"text {i}".encode()) for i in (0, 1, 2, 2)], S.FILES)
    index_changes(table, files, files.selectExpr("path", "'A' AS op"), repo="r", model=HashingModel(8), dim=8)
    assert sorted(r.chunk for r in table.read().collect()) == ["text 0", "text 1", "text 2"]
    assert "_code" in moved[-1]._jdf.queryExecution().analyzed().toString()


def test_whole_changes_are_compared_only_for_the_last_of_a_path(spark, table, monkeypatch):
    from lodestone.streaming import delta

    compared, whole = [], delta.latest
    def noted(rows, *more):
        compared.append(sorted((r.path or "", r.seq) for r in rows.collect()))
        return whole(rows, *more)
    monkeypatch.setattr(delta, "latest", noted)
    log = [(seq, "main", f"{seq % 3}.txt", "M", bytearray(b"text %d" % seq)) for seq in range(40)]
    for part in (log[20:], log[:20], log[:20] + [(37, "main", "0.txt", "M", bytearray(b"late"))]):
        merge_batch(table, spark.createDataFrame(part, STREAM), repo="repo", model=HashingModel(DIM), dim=DIM)
    assert compared == [[("0.txt", 39), ("1.txt", 37), ("2.txt", 38)], [], []]
    assert sorted(r.chunk for r in table.read().collect()) == ["text 37", "text 38", "text 39"]
