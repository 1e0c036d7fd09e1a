"""Keeping an index up to date from a stream of file changes.

Every micro-batch is merged by id and path, so a batch that is run again after
a failure leaves the index as it was. Of each branch's path the last number merged is kept
beside the index, and a change with a smaller one is passed over, so changes may
come late, twice, and in any split into batches.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone import config as C
from lodestone.operators.chunk import chunk_files
from lodestone.operators.embed import Loader, error_reports, HashingModel, with_embeddings
from lodestone.plans.checkpoint import dropped, likely, staged
from lodestone.plans.indexing import replaced
from lodestone.sources.index_table import bucket_of, IndexTable, index_rows, latest
from lodestone.sources.segments import FRESH, Segments

TIMEOUT_EXIT_CODE = 75
# Batches after which the numbers kept are merged to one per path.
MOST_DELTAS = 16


class LastChanges:
    """The number of the last change merged of each ``branch, path``, by hash of the path."""

    def __init__(self, table: IndexTable):
        self.buckets = table.buckets
        self.segments = Segments(table.spark, f"{table.batches}_seen", {"seen": "branch string, path string, seq long"})

    def not_older(self, changes: DataFrame) -> DataFrame:
        """``changes`` without those of a smaller number than one merged before.

        Of the numbers kept, those in the parts of the paths are read; the filter on the
        small side prunes them when the job runs.
        """
        seen = self.segments.read("seen")
        part = bucket_of(F.col("path"), self.buckets)
        keys = changes.select(part.alias("part")).distinct().where(F.col("part") >= 0)
        kept = seen.where(F.col("part") == FRESH).select("branch", "path", "seq").unionByName(
            seen.join(keys, "part", "left_semi").select("branch", "path", "seq"))
        known = kept.groupBy(F.col("branch").alias("_branch"), F.col("path").alias("_path")).agg(F.max("seq").alias("_seq"))
        same = changes["branch"].eqNullSafe(known["_branch"]) & (changes["path"] == known["_path"])
        return changes.join(known, same & (known["_seq"] > changes["seq"]), "left_anti")

    def keep(self, changes: DataFrame) -> None:
        """Note the numbers of merged changes, as one delta."""
        number = self.segments.next_number()
        self.segments.write("seen", number, changes.select("branch", "path", "seq", F.lit(FRESH).alias("part")))
        self.segments.commit(number, base=False)
        if len(self.segments.log()) > MOST_DELTAS:
            self.compact()

    def compact(self) -> None:
        self.segments.vacuum()
        number = self.segments.next_number()
        rows = self.segments.read("seen").groupBy("branch", "path").agg(F.max("seq").alias("seq"))
        self.segments.write("seen", number, rows.withColumn("part", bucket_of(F.col("path"), self.buckets)), "path")
        self.segments.commit(number, base=True)


def merge_batch(
    table: IndexTable,
    batch: DataFrame,
    *,
    repo: str,
    model: Loader | None = None,
    dim: int = C.EMBEDDING_DIM,
    batch_id: int | None = None,
) -> DataFrame:
    """Apply ``seq, branch, path, op, content`` rows; of a branch's path the last one counts.

    The last one of all batches, that is: an older change that comes later is passed
    over, one of the same number is merged again. Rows without a number are the oldest. A file whose chunks could not all be embedded keeps its former ones. What
    failed is returned and, with ``batch_id``, kept in ``<table>_errors``, where
    a batch that is run again replaces its own rows. The batch is read twice, so it has
    to be one that Spark can read again, as those of a stream are.
    """
    known = LastChanges(table)
    changes = batch.where(F.col("op").isin("A", "M", "D")).withColumn(
        "seq", F.coalesce(F.col("seq").cast("long"), F.lit(-1 << 63)))
    # Chosen by number first, without contents; whole rows that lose stay where they lie and are not sorted.
    numbers = staged(known.not_older(changes.groupBy("branch", "path").agg(F.max("seq").alias("seq"))), "numbers")
    newest = likely(changes, numbers, ["branch", "path", "seq"])
    last = staged(known.not_older(latest(newest, ["branch", "path"], [F.col("seq")])), "changes")
    files = last.where(F.col("op").isin("A", "M")).select(
        F.lit(repo).alias("repo"), "branch", "path", "content"
    )
    chunks = chunk_files(files)
    embedded = staged(with_embeddings(chunks, model or HashingModel(dim), dim=dim), "embedded")
    rows = index_rows(embedded.where(F.col("error").isNull()), dim)
    gone = last.where(F.col("op") == "D").select("branch", "path")
    table.replace_paths(rows, gone, repo, replaced(files, embedded))
    known.keep(last)
    errors = staged(error_reports(embedded), "errors")
    if batch_id is not None:
        _keep_errors(table, errors.withColumn("batch", F.lit(batch_id)))
    dropped(numbers, last, embedded)
    return errors


def _keep_errors(table: IndexTable, errors: DataFrame) -> None:
    name = f"{table.table}_errors"
    columns = ", ".join(f"{c} {t}" for c, t in errors.dtypes)
    table.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (batch)")
    errors.write.mode("overwrite").insertInto(name)


def index_stream(
    changes: DataFrame, table: IndexTable, checkpoint: str, *, repo: str, **options
) -> StreamingQuery:
    """Start a query that merges every micro-batch and stops at the end of the input."""
    def apply(batch: DataFrame, number: int) -> None:
        merge_batch(table, batch, repo=repo, batch_id=number, **options)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery, deadline_seconds: float = 0, clock: Callable = time.monotonic) -> int:
    """Wait for ``query``; past a deadline stop it and return the retry exit code.

    Zero means no deadline. What is merged stays, and the checkpoint makes the
    next run go on behind it.
    """
    started = clock()
    while not query.awaitTermination(1):
        if deadline_seconds > 0 and clock() - started > deadline_seconds:
            query.stop()
            return TIMEOUT_EXIT_CODE
    return 0
