"""From a change set to an updated index."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone import config as C
from lodestone.operators.chunk import chunk_files
from lodestone.operators.embed import Loader, error_reports, HashingModel, with_embeddings
from lodestone.plans.checkpoint import dropped, staged
from lodestone.sources.files import is_binary, is_ignored
from lodestone.sources.index_table import IndexTable, index_rows, same_file


@dataclass
class IndexingReport:
    processed_chunks: int = 0
    processed_files: int = 0
    deleted_files: int = 0
    skipped_binary: int = 0
    errors: DataFrame | None = field(default=None, repr=False)


def split_changes(changes: DataFrame, ignore: str = "") -> tuple[DataFrame, DataFrame]:
    """Paths to read and paths to delete; ignored ones are in neither.

    Where changes name a branch, it stays with the path.
    """
    kept = changes.where(~is_ignored(F.col("path"), ignore))
    keys = [c for c in ("branch", "path") if c in changes.columns]
    return (
        kept.where(F.col("op").isin("A", "M")).select(*keys).distinct(),
        kept.where(F.col("op") == "D").select(*keys).distinct(),
    )


def not_yet_indexed(paths: DataFrame, indexed: DataFrame) -> DataFrame:
    """What a full run has left to do after one that was cut short."""
    return paths.join(indexed, "path", "left_anti")


def of_paths(files: DataFrame, paths: DataFrame) -> DataFrame:
    """Files on a list of paths; Spark broadcasts the list while it is small."""
    return files.join(paths, same_file(files, paths), "left_semi")


def replaced(files: DataFrame, embedded: DataFrame) -> DataFrame:
    """``branch, path`` of the files none of whose chunks failed to be embedded.

    Only of these the former chunks may go.
    """
    failed = embedded.where(F.col("error").isNotNull()).select("branch", "path").distinct()
    tried = files.select("branch", "path").distinct()
    return tried.join(failed, same_file(tried, failed), "left_anti")


def metrics(embedded: DataFrame, deleted: DataFrame) -> DataFrame:
    """One row of counters for a run."""
    good = embedded.where(F.col("error").isNull())
    return good.agg(
        F.count("*").alias("processed_chunks"),
        F.count_distinct("repo", "path").alias("processed_files"),
    ).withColumn("deleted_files", deleted.agg(F.count("*")).scalar())


def index_changes(
    table: IndexTable,
    files: DataFrame,
    changes: DataFrame,
    *,
    repo: str,
    full: bool = False,
    ignore: str = "",
    model: Loader | None = None,
    dim: int = C.EMBEDDING_DIM,
    batch: int = C.EMBEDDING_BATCH,
    keep_stale: bool = False,
) -> IndexingReport:
    """Bring the index of one repository up to date.

    ``files`` has the content of the new version and ``changes`` its paths with
    an op, and the branch where it matters. Chunks of deleted paths go, on all
    branches if none is named. Those of the former version of a file go, on its
    own branch, once all its new chunks are embedded, unless ``keep_stale`` asks
    for the plain merge by id. Chunks are embedded once and written down before
    the index is touched, so a lost executor repeats its own tasks and no model run.
    """
    wanted, deleted = split_changes(changes, ignore)
    if full:
        wanted = not_yet_indexed(wanted, table.indexed_paths(repo))
    wanted, deleted = staged(wanted, "wanted"), staged(deleted, "deleted")
    present = of_paths(files.where(F.col("repo") == repo), wanted).withColumn(
        "_binary", is_binary(F.col("content"))
    )
    named = staged(present.select("branch", "path", "_binary"), "files")
    chunks = chunk_files(present.where(~F.col("_binary")).drop("_binary"))
    embedded = staged(
        with_embeddings(chunks, model or HashingModel(dim), dim=dim, batch=batch), "embedded"
    )
    rows = index_rows(embedded.where(F.col("error").isNull()), dim)
    table.replace_paths(rows, deleted, repo, None if keep_stale else replaced(named, embedded))
    counted = metrics(embedded, deleted).first()
    report = IndexingReport(
        counted["processed_chunks"],
        counted["processed_files"],
        counted["deleted_files"],
        named.where("_binary").count(),
        staged(error_reports(embedded), "errors"),
    )
    dropped(wanted, deleted, named, embedded)
    return report
