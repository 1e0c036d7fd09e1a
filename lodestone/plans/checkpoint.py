"""Results that must not be computed twice are written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys whose codes, eight bytes each, are sent to every task.
NAMED_KEYS = 1 << 21


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor can reach.

    Where the setting is absent a local session gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def staged(rows: DataFrame, name: str = "rows") -> DataFrame:
    """``rows`` written once as Parquet and read back, with columns pruned by every reader.

    The files go when the application ends, or before that by ``dropped``.
    """
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/staged-{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    files, path = file_system(spark, folder)
    files.deleteOnExit(path)
    return spark.read.schema(rows.schema).parquet(folder)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of staged rows that nobody will read again."""
    for rows in tables:
        folders = {name.rsplit("/", 1)[0] for name in rows.inputFiles()}
        for folder in folders:
            files, path = file_system(rows.sparkSession, folder)
            files.delete(path, True)


def codes(keys: DataFrame, on: list[str | Column]) -> DataFrame | None:
    """``_code`` of each key once, None where there are more than tasks should hold."""
    found = staged(keys.select(F.xxhash64(*on).alias("_code")).distinct(), "codes")
    return found if found.count() <= NAMED_KEYS else None


def likely(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without nearly all whose ``on`` is not in ``keys``, told where they lie.

    A join that needs exact keys follows, and has few rows left to move. With more keys
    than tasks should hold it has all of them.
    """
    known = codes(keys, on)
    if known is None:
        return rows
    return rows.withColumn("_code", F.xxhash64(*on)).join(F.broadcast(known), "_code", "left_semi").drop("_code")


def collected(spark: SparkSession) -> None:
    """Let go of shuffle files whose rows nobody refers to; Spark looks for them when the driver collects garbage."""
    spark._jvm.System.gc()


def exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def children(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers behind ``prefix`` in the names of what a folder holds."""
    files, at = file_system(spark, folder)
    if not files.exists(at):
        return []
    names = [status.getPath().getName() for status in files.listStatus(at)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))
