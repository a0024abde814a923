"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, one made for this session if it is a local one.

    On a cluster the executors couldn't share such a folder, so there it has to be set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        held = spark.sparkContext.getCheckpointDir()
        if held is None:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallygrid-"))
            held = spark.sparkContext.getCheckpointDir()
        folder = held
    return folder.rstrip("/")


def import_on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if they don't have it otherwise."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the time being, where this Spark has it."""
    if not spark.conf.isModifiable(key):
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Tables written once, so that a lost executor costs a read and not the work before it.

    ``drop`` removes a table that a later one has replaced. What is kept stays until the caller
    removes ``folder``, since results are read from it lazily.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        import_on_workers(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        # What was shuffled for this table has no use once it is stored. Spark below 4.1 leaves it until the driver collects garbage.
        with _set(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Rows from the driver as a constant of the plan: no Python worker and no job to read them."""
    names = [field.split()[0] for field in schema.split(",")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    made = F.from_json(F.lit(text), f"array<struct<{', '.join(f.strip().replace(' ', ': ', 1) for f in schema.split(','))}>>")
    return spark.range(1, numPartitions=1).select(F.inline(made))
