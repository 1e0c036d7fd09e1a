"""Session settings the jobs rely on; nothing here fits one machine only."""

from __future__ import annotations

import shutil
import tempfile
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Files differ in size by orders of magnitude, so batches are bounded by
    # bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # What is staged and stored takes less of the disk that all executors share.
    "spark.sql.parquet.compression.codec": "zstd",
}


@cache
def ship(context: SparkContext) -> None:
    """Send this package to the executors, wherever the driver was started from."""
    package = Path(__file__).parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="lodestone-")) / package.name),
        "zip", root_dir=package.parent, base_dir=package.name,
    )
    context.addPyFile(archive)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark.sparkContext)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and small runs."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lodestone")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Leave out the call site of every column; plans are built twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        # The sample tables are of one row group each.
        .config("lodestone.spread", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark.sparkContext)
    return spark
