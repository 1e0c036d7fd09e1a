"""Append-only storage in numbered segments, and the log that makes them visible.

A segment is either a base, which holds everything there is at that point, or a delta
behind it. Its files are written first and one log entry then makes all its tables
visible at once; a segment without an entry is never read, and the next writer
takes its number and overwrites it. So a writer that is lost at any moment leaves the
former state, and a batch that runs again under its own number leaves the same state. There
is one writer at a time.

A row is dead when a later segment names its id as gone. Compaction writes a new base
of the living rows; the files before it are deleted by the compaction after that, so a
reader that began before it still finds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.plans.checkpoint import children, codes, exists, file_system

FRESH = -1  # the part of rows that no compaction has placed yet
_LOG = "segment long, base boolean, facts map<string,long>"


def warehouse_folder(spark: SparkSession, name: str) -> str:
    """A folder for ``name`` in the warehouse, which all executors reach."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"


class Segments:
    """Tables of one folder; ``parts`` are partitioned by a number ``part``, ``gone`` lists dead ids."""

    def __init__(self, spark: SparkSession, folder: str, parts: dict[str, str], plain: dict[str, str] | None = None):
        self.spark, self.folder = spark, folder
        self.parted = set(parts)
        self.kinds = {
            name: T.StructType.fromDDL(columns + (", segment long, part int" if name in self.parted else ", segment long"))
            for name, columns in {**parts, **(plain or {}), "gone": "id string"}.items()
        }

    def _children(self, path: str) -> list[int]:
        """Numbers of the segments that have files, or an entry, in a folder."""
        return children(self.spark, path, "segment=")

    def log(self) -> list[T.Row]:
        """The visible segments: the last base and the deltas behind it, one row each."""
        if not self._children(f"{self.folder}/log"):
            return []
        entries = self.spark.read.schema(_LOG).option("recursiveFileLookup", "true").parquet(f"{self.folder}/log")
        rows = sorted(entries.collect(), key=lambda r: r["segment"])
        bases = [i for i, r in enumerate(rows) if r["base"]]
        return rows[bases[-1] if bases else 0:]

    def next_number(self) -> int:
        log = self.log()
        return log[-1]["segment"] + 1 if log else 1

    def read(self, name: str, segments: list[int] | None = None) -> DataFrame:
        """Rows of a table in the visible segments, dead ones included."""
        wanted = [r["segment"] for r in self.log()] if segments is None else segments
        paths = [p for p in (f"{self.folder}/{name}/segment={s}" for s in wanted) if exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], self.kinds[name])
        return self.spark.read.schema(self.kinds[name]).option("basePath", f"{self.folder}/{name}").parquet(*paths)

    def gone(self, log: list[T.Row]) -> DataFrame | None:
        """Dead ids with the last segment that says so; None where there are none."""
        some = [r["segment"] for r in log if (r["facts"] or {}).get("gone")]
        if not some:
            return None
        return self.read("gone", some).groupBy("id").agg(F.max("segment").alias("gone_at"))

    def alive(self, rows: DataFrame, log: list[T.Row]) -> DataFrame:
        """``rows``, with their ``id`` and ``segment``, that no later segment names."""
        gone = self.gone(log)
        if gone is None:
            return rows
        return rows.join(gone, (rows["id"] == gone["id"]) & (gone["gone_at"] > rows["segment"]), "left_anti")

    def alive_in_place(self, rows: DataFrame, log: list[T.Row]) -> DataFrame:
        """The same, for wide rows: those that no segment is likely to name stay where they lie, and are read twice."""
        gone = self.gone(log)
        known = None if gone is None else codes(gone, ["id"])
        if known is None:
            return self.alive(rows, log)
        coded = rows.withColumn("_code", F.xxhash64("id"))
        sure = coded.join(F.broadcast(known), "_code", "left_anti").drop("_code")
        return sure.unionByName(self.alive(coded.join(F.broadcast(known), "_code", "left_semi").drop("_code"), log))

    def write(self, name: str, number: int, rows: DataFrame, *order: str, dealt: bool = False) -> None:
        """Write a table's rows of a segment in place of any that are there; ``dealt`` ones are not moved again."""
        writer = rows
        if name in self.parted:
            # Rebalancing splits a part that many rows fall into over tasks and files.
            writer = (rows if dealt else rows.hint("rebalance", "part")).sortWithinPartitions("part", *order)
        out = writer.write.mode("overwrite")
        (out.partitionBy("part") if name in self.parted else out).parquet(f"{self.folder}/{name}/segment={number}")

    def commit(self, number: int, base: bool, **facts: int) -> None:
        """Make a written segment visible."""
        entry = self.spark.range(1).select(
            F.lit(number).cast("long").alias("segment"), F.lit(base).alias("base"),
            F.create_map(*[F.lit(x).cast("long") if i % 2 else F.lit(x) for pair in facts.items() for i, x in enumerate(pair)])
            .alias("facts") if facts else F.lit(None).cast("map<string,bigint>").alias("facts"),
        )
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/log/segment={number}")

    def vacuum(self) -> None:
        """Delete the files of segments before the visible base."""
        log = self.log()
        first = log[0]["segment"] if log else 0
        for name in (*self.kinds, "log"):
            for number in self._children(f"{self.folder}/{name}"):
                if number < first:
                    files, at = file_system(self.spark, f"{self.folder}/{name}/segment={number}")
                    files.delete(at, True)

    def drop(self) -> None:
        """Delete everything."""
        files, at = file_system(self.spark, self.folder)
        files.delete(at, True)


def of_parts(parts: list[int]) -> Column:
    """Rows of the named parts and of those not placed yet; a partition filter."""
    return F.col("part").isin([FRESH, *parts])
