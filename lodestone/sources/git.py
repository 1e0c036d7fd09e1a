"""Changed paths between two commits, as a batch and as a streaming source."""

from __future__ import annotations

import subprocess
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    InputPartition,
    SimpleDataSourceStreamReader,
)

from lodestone.sources.files import is_ignored


def run_git(root: str, *args: str) -> str:
    done = subprocess.run(
        ["git", "-C", root, "-c", "core.quotePath=false", *args], capture_output=True, text=True
    )
    if done.returncode:
        raise RuntimeError(f"git {args[0]} failed: {done.stderr.strip()}")
    return done.stdout


def empty_tree(root: str) -> str:
    return run_git(root, "hash-object", "-t", "tree", "/dev/null").strip()


def resolve_range(
    root: str, start: str | None = None, end: str | None = None, full: bool = False
) -> tuple[str, str]:
    """Both ends of a diff: by default the last commit, everything when ``full``."""
    last = end or run_git(root, "rev-parse", "HEAD").strip()
    if full:
        return empty_tree(root), last
    if start:
        return start, last
    try:
        return run_git(root, "rev-parse", "HEAD^").strip(), last
    except RuntimeError:
        return empty_tree(root), last


def changed_paths(root: str, start: str, end: str) -> Iterator[tuple[str, str]]:
    """(path, op) with op A, M or D; a rename is a deletion and an addition."""
    listing = run_git(root, "diff", "--name-status", "--no-renames", "-z", f"{start}..{end}")
    fields = iter(listing.split("\0"))
    for op in fields:
        if op and (path := next(fields, None)) and op in ("A", "M", "D"):
            yield path, op


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        # Names only, so one task lists them; the files are read in parallel.
        return [InputPartition(0)]

    def read(self, partition):
        root = self.options["root"]
        full = str(self.options.get("full", "false")).lower() == "true"
        start, end = resolve_range(root, self.options.get("from"), self.options.get("to"), full)
        return changed_paths(root, start, end)


class _StreamReader(SimpleDataSourceStreamReader):
    """A stream whose offset is a commit."""

    def __init__(self, options):
        self.options = options

    def initialOffset(self):
        return {"commit": self.options.get("from") or empty_tree(self.options["root"])}

    def read(self, start):
        root = self.options["root"]
        end = {"commit": run_git(root, "rev-parse", self.options.get("to") or "HEAD").strip()}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start, end):
        return iter(list(changed_paths(self.options["root"], start["commit"], end["commit"])))


class GitChanges(DataSource):
    """``spark.read.format("git_changes").option("root", ...)``."""

    @classmethod
    def name(cls):
        return "git_changes"

    def schema(self):
        return "path string, op string"

    def reader(self, schema):
        return _BatchReader(self.options)

    def simpleStreamReader(self, schema):
        return _StreamReader(self.options)


def git_changes(
    spark: SparkSession,
    root: str,
    *,
    start: str | None = None,
    end: str | None = None,
    full: bool = False,
    ignore: str = "",
) -> DataFrame:
    """Changes of a working tree without the ignored paths."""
    spark.dataSource.register(GitChanges)
    reader = spark.read.format("git_changes").option("root", root).option("full", str(full))
    for key, value in (("from", start), ("to", end)):
        if value:
            reader = reader.option(key, value)
    return reader.load().where(~is_ignored(F.col("path"), ignore))
