"""The chunk index: a Parquet table that batches are merged into.

Rows lie in partitions by repository and by a hash of their path, so a batch
rewrites the partitions of the paths it touches and nothing else, also when one
repository holds a third of all rows. The postings of the chunks are kept by word in a
``PostingsStore``, to which a batch adds one delta.

A batch is one commit for both. Its rows, what it deletes and which chunks go by it are
written to a folder of its own first, and a marker there makes it a batch. Then the
chunks are rewritten, the postings get their delta, and the folder goes. Each step may be
repeated, so a batch that was cut short is finished by the next writer, or by ``recover``.
There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone import schema as S
from lodestone.config import SearchSettings
from lodestone.functions.analysis import lexemes, words
from lodestone.functions.vector import checked
from lodestone.operators.fusion import fetched, rrf
from lodestone.operators.keyword import corpus_stats, like, top_by
from lodestone.operators.vectors import vector_search
from lodestone.plans.checkpoint import children, codes, collected, dropped, exists, file_system, staged
from lodestone.sources.postings_store import PostingsStore
from lodestone.sources.registry import StoreConfig, register_store
from lodestone.sources.segments import warehouse_folder

BUCKETS = 64
BUCKETS_PROPERTY = "lodestone.buckets"
# Folders of a table carry a mark of their own, so that a new table of an old name finds none.
FOLDER_PROPERTY = "lodestone.folder"
# Deltas of the postings after which they are compacted.
MOST_DELTAS = 16
# Partitions named in one statement.
DROPPED_AT_ONCE = 1000


def bucket_of(path: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row per key, as the later of two writes wins."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.desc() for c in order]))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def upserted(existing: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """``existing`` with every row of ``incoming`` added or put in its place."""
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming)


def same_file(rows: DataFrame, paths: DataFrame) -> Column:
    """Rows on a list of paths, and of their branch and repository where the list names them."""
    condition = rows["path"] == paths["path"]
    for name in ("repo", "branch"):
        if name in paths.columns:
            condition &= rows[name].eqNullSafe(paths[name])
    return condition


def without_paths(existing: DataFrame, paths: DataFrame, repo: str | None = None) -> DataFrame:
    """``existing`` without the rows of ``paths`` in one or in every repository.

    Where ``paths`` names branches, rows of other branches stay.
    """
    gone = paths.select(*[c for c in ("branch", "path") if c in paths.columns]).distinct()
    if repo is not None:
        gone = gone.withColumn("repo", F.lit(repo))
    return existing.join(gone, same_file(existing, gone), "left_anti")


def one_per_id(rows: DataFrame) -> DataFrame:
    """``rows`` with each id once; rows that differ under one id fail the job."""
    same = Window.partitionBy("id")
    code = F.xxhash64(*rows.columns)
    marked = rows.withColumn("_code", code).withColumns({
        "_place": F.row_number().over(same.orderBy("_code")),
        "_differ": F.min("_code").over(same) != F.max("_code").over(same),
    })
    checked_id = F.when(F.col("_differ"), F.raise_error(
        F.concat(F.lit("different rows under one id, and no order is given: "), F.col("id"))
    )).otherwise(F.col("id"))
    return marked.where("_place = 1").withColumn("id", checked_id).select(*rows.columns)


def parted(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose id has none of the ``known`` codes, told where they lie, and the others."""
    coded = rows.withColumn("_code", F.xxhash64("id"))
    sure, others = (coded.join(F.broadcast(known), "_code", how).drop("_code") for how in ("left_anti", "left_semi"))
    return sure, others


def without_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` under none of ``ids``; whole rows stay where they lie unless there are very many ids.

    Of rows whose code is that of one of the ids only ids are moved, and those that share no more than the code are kept by these.
    """
    ids = ids.where("id is not null")
    known = codes(ids, ["id"])
    if known is None:
        return rows.join(ids, "id", "left_anti")
    sure, others = parted(rows, known)
    alike = staged(others.select("id").join(ids, "id", "left_anti").distinct(), "alike")
    if alike.isEmpty():
        return sure
    return sure.unionByName(others.join(F.broadcast(alike), others["id"].eqNullSafe(alike["id"]), "left_semi"))


def without_orphans(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """Postings whose chunk is still there."""
    return index.join(chunks.select("id"), "id", "left_semi")


def indexed_paths(chunks: DataFrame, repo: str | None = None) -> DataFrame:
    rows = chunks if repo is None else chunks.where(F.col("repo") == repo)
    return rows.where(F.col("path").isNotNull()).select("path").distinct()


def index_rows(embedded: DataFrame, dim: int) -> DataFrame:
    """Embedded chunks in the layout of the index; a wrong embedding fails the job."""
    return embedded.where(F.col("id").isNotNull()).withColumns({
        "embedding": checked(F.col("embedding"), dim),
        "n_words": F.size(words(F.col("chunk"))),
        "lexemes": lexemes(F.col("chunk")),
    }).select(
        *[
            F.lit("committed").alias(c) if c == "status"
            else F.lit(None).cast("string").alias(c) if c == "mutation_id"
            else F.col("chunk").alias(c) if c == "search_vector"
            else F.col(c)
            for c in S.INDEX.fieldNames()
        ]
    )


class IndexTable:
    """Create, read, merge into and delete from one index."""

    def __init__(
        self,
        spark: SparkSession,
        config: StoreConfig = StoreConfig(),
        buckets: int | None = None,
        keep_postings: bool = True,
    ):
        self.spark = spark
        self.table = config.table
        self.bootstrap(buckets)
        name = config.postings or f"{config.table}_fts"
        self.store = PostingsStore(spark, warehouse_folder(spark, f"{name}_{self._mark}")) if keep_postings else None
        self.batches = warehouse_folder(spark, f"{self.table}_batches_{self._mark}")

    def bootstrap(self, buckets: int | None = None) -> None:
        """Create the table and add missing columns; repeating it changes nothing.

        The number of buckets is a property of the table, as rows of one path
        must always lie in the same one.
        """
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in S.INDEX if f.name != "repo"
        )
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, repo string, bucket int) "
            "USING parquet PARTITIONED BY (repo, bucket)"
        )
        properties = {
            r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").collect()
        }
        stored, mark = properties.get(BUCKETS_PROPERTY), properties.get(FOLDER_PROPERTY)
        if stored is not None and buckets is not None and int(stored) != buckets:
            raise ValueError(f"{self.table} has {stored} buckets, not {buckets}")
        self.buckets, self._mark = int(stored or buckets or BUCKETS), mark or uuid.uuid4().hex[:12]
        if stored is None or mark is None:
            self.spark.sql(
                f"ALTER TABLE {self.table} SET TBLPROPERTIES "
                f"('{BUCKETS_PROPERTY}' = '{self.buckets}', '{FOLDER_PROPERTY}' = '{self._mark}')"
            )
        present = set(self.spark.table(self.table).columns)
        for field in S.INDEX:
            if field.name not in present:
                self.spark.sql(
                    f"ALTER TABLE {self.table} ADD COLUMNS ({field.name} {field.dataType.simpleString()})"
                )

    def drop(self) -> None:
        """Delete the table, its postings and what is left of batches."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self.store:
            self.store.drop()
        files, at = file_system(self.spark, self.batches)
        files.delete(at, True)

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*S.INDEX.fieldNames())

    def read_postings(self) -> DataFrame:
        """The living postings, a row per chunk and word."""
        return self.store.read()

    def indexed_paths(self, repo: str | None = None) -> DataFrame:
        return indexed_paths(self.read(), repo)

    def stats(self, id_words: int = 1) -> DataFrame:
        return corpus_stats(self.read(), id_words)

    def search(
        self,
        chunks: DataFrame,
        query_vector: Sequence[float],
        query: str,
        limit: int = 10,
        *,
        repo: str | None = None,
        branch: str | None = None,
        settings: SearchSettings = SearchSettings(),
    ) -> DataFrame:
        """Hybrid search by rank that finds words through the stored postings.

        To be passed to ``retrieve`` as its ``search``, with the rows of ``read()``.
        """
        text, take = (query or "").strip(), settings.candidates(limit)
        found = staged(self.store.top(text, take, repo=repo, branch=branch).rows, "hits")
        if found.isEmpty():
            matching = like(chunks, text, repo=repo, branch=branch).select("id", "keyword_score")
            found = top_by(matching, "keyword_score", take)
        apart = chunks.select("id", "repo", "branch", "embedding")
        near = vector_search(apart, query_vector, take, repo=repo, branch=branch)
        narrow = chunks.select(*[c for c in S.RESULT_COLUMNS if c in chunks.columns])
        return fetched(narrow, rrf(found, near.select("id", "vector_score"), limit, settings))

    def upsert(self, rows: DataFrame, order: str | None = None) -> None:
        """Merge ``rows`` by id; of equal ids in a batch the last by ``order`` stays.

        Without an order, rows under one id must be the same.
        """
        rows = rows.where(F.col("id").isNotNull())
        self._apply(latest(rows, ["id"], [F.col(order)]) if order else rows, None)

    def delete(self, paths: DataFrame, repo: str | None = None) -> None:
        """Remove all chunks of ``paths``; without any path nothing happens."""
        self._apply(None, self._deletions(paths, repo))

    def replace_paths(
        self, rows: DataFrame, paths: DataFrame, repo: str, replaced: DataFrame | None = None
    ) -> None:
        """Delete ``paths``, and files ``replaced``, and merge ``rows`` in one commit.

        ``paths`` may name branches, ``replaced`` does.
        """
        gone = self._deletions(paths, repo)
        if replaced is not None:
            gone = gone.unionByName(self._deletions(replaced, repo))
        self._apply(rows, gone)

    def _deletions(self, paths: DataFrame, repo: str | None) -> DataFrame:
        """``repo, path, branch, any_branch`` of files that go; without a repository, in each that has the path's bucket."""
        named = "branch" in paths.columns
        rows = paths.select(
            "path", (F.col("branch") if named else F.lit(None)).cast("string").alias("branch"),
            F.lit(not named).alias("any_branch"), bucket_of(F.col("path"), self.buckets).alias("bucket"),
        ).distinct()
        if repo is not None:
            return rows.withColumn("repo", F.lit(repo))
        return rows.join(self.spark.table(self.table).select("repo", "bucket").distinct(), "bucket")

    # --- batches ---------------------------------------------------------------

    def _apply(self, rows: DataFrame | None, deletions: DataFrame | None) -> None:
        self.recover()
        if rows is None:
            rows = self.spark.createDataFrame([], S.INDEX)
        number = max(self.store.last_batch() if self.store else 0, 0) + 1
        folder = f"{self.batches}/batch={number}"
        given = rows.select(*S.INDEX.fieldNames())
        bucket = bucket_of(F.col("path"), self.buckets)
        given.withColumn("bucket", bucket).write.mode("overwrite").parquet(f"{folder}/rows")
        written = self.spark.read.parquet(f"{folder}/rows").drop("bucket")
        # Whole rows are moved only where ids repeat, and only those.
        repeated = staged(written.groupBy("id").count().where("count > 1").select("id"), "repeated")
        if not repeated.isEmpty():
            known = codes(repeated, ["id"])
            once = one_per_id(written)
            if known is not None:
                single, others = parted(written, known)
                once = single.unionByName(one_per_id(others))
            once.withColumn("bucket", bucket).write.mode("overwrite").parquet(f"{folder}/once")
        dropped(repeated)
        if deletions is None:
            deletions = self._deletions(self.spark.createDataFrame([], "path string"), "")
        deletions.write.mode("overwrite").parquet(f"{folder}/deletions")
        rows, gone, touched = self._batch(folder)
        existing = self._scope(touched)
        dead = existing.join(gone, self._goes(existing, gone), "left_semi").select("id").unionByName(
            existing.join(rows.select("id"), "id", "left_semi").select("id"))
        dead.distinct().write.mode("overwrite").parquet(f"{folder}/dead")
        self.spark.range(1).write.mode("overwrite").parquet(f"{folder}/ready")
        self._finish(number, first=True)

    def recover(self) -> None:
        """Finish a batch that was cut short; one that was not complete yet has changed nothing and goes."""
        for number in children(self.spark, self.batches, "batch="):
            folder = f"{self.batches}/batch={number}"
            if exists(self.spark, f"{folder}/ready/_SUCCESS"):
                self._finish(number)
            else:
                self._forget(folder)

    def _batch(self, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows and deletions of a stored batch, and the partitions they touch."""
        once = "once" if exists(self.spark, f"{folder}/once/_SUCCESS") else "rows"
        rows, gone = (self.spark.read.parquet(f"{folder}/{name}") for name in (once, "deletions"))
        touched = staged(rows.select("repo", "bucket").unionByName(gone.select("repo", "bucket")).distinct(), "touched")
        return rows, gone, touched

    def _finish(self, number: int, first: bool = False) -> None:
        folder = f"{self.batches}/batch={number}"
        rows, _, touched = self._batch(folder)
        dead = self.spark.read.schema("id string").parquet(f"{folder}/dead")
        # Ids of the batch that were there are dead; a step that is repeated may find the others as well.
        replaced = dead if first else dead.unionByName(rows.select("id")).distinct()
        self._rewrite(rows, replaced, touched)
        collected(self.spark)
        if self.store and self.store.last_batch() < number:
            self.store.commit(rows, dead, number)
        self._forget(folder)
        collected(self.spark)
        if self.store and len(self.store.segments.log()) > MOST_DELTAS:
            self.store.compact()

    def _forget(self, folder: str) -> None:
        # The marker goes first, so that no half-deleted batch is finished again.
        for path in (f"{folder}/ready", folder):
            files, at = file_system(self.spark, path)
            files.delete(at, True)

    @staticmethod
    def _goes(rows: DataFrame, gone: DataFrame) -> Column:
        """Rows on a list of deletions."""
        return (rows["path"] == gone["path"]) & (rows["repo"] == gone["repo"]) & (
            gone["any_branch"] | rows["branch"].eqNullSafe(gone["branch"]))

    def _scope(self, touched: DataFrame) -> DataFrame:
        """The rows of the touched partitions.

        The filter on the small side makes Spark prune partitions by it when it runs.
        """
        keys = touched.columns
        return self.spark.table(self.table).join(
            touched.where("bucket >= 0").distinct(), keys, "left_semi"
        )

    def _rewrite(self, rows: DataFrame, replaced: DataFrame, touched: DataFrame) -> None:
        """Merge a batch into the chunks, in place of ``replaced`` ids."""
        if touched.isEmpty():
            return
        existing = self._scope(touched)
        changed = without_ids(existing, replaced).unionByName(rows)
        emptied = self._emptied(existing, changed)
        # Rebalancing splits a large partition over several tasks and files.
        (
            changed.select(*self.spark.table(self.table).columns)
            .hint("rebalance", "repo", "bucket")
            .write.mode("overwrite").insertInto(self.table)
        )
        self._drop(self.table, emptied)

    @staticmethod
    def _emptied(existing: DataFrame, changed: DataFrame) -> list:
        """Partitions that lose all rows; an overwrite would leave them as they are."""
        before = existing.select("repo", "bucket").distinct()
        after = changed.select("repo", "bucket").distinct()
        return before.join(after, ["repo", "bucket"], "left_anti").collect()

    def _drop(self, table: str, partitions: list) -> None:
        for at in range(0, len(partitions), DROPPED_AT_ONCE):
            parts = ", ".join(
                f"PARTITION (repo='{_quoted(repo)}', bucket={bucket})"
                for repo, bucket in partitions[at:at + DROPPED_AT_ONCE]
            )
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
        self.spark.catalog.refreshTable(table)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


register_store("parquet", lambda spark, config, **more: IndexTable(spark, config, **more))
