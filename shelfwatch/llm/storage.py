"""Intermediate tables in the shared scratch folder.

Operators cut lineage with written tables, so a lost executor repeats tasks, not the whole plan.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from shelfwatch.session import scratch_folder


class Scratch:
    """Written tables of one operator run below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.folder = scratch_folder(spark, purpose)
        self._count = 0

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; the result has no lineage but its files."""
        self._count += 1
        path = f"{self.folder}/{self._count:03d}-{name}"
        df.write.parquet(path)
        self._release()
        # The schema is known: no job reads footers, and an empty table keeps its columns.
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored.scratch_path = path
        return stored

    def _release(self) -> None:
        """Let go of the shuffles of finished steps: Spark deletes their files when the driver has no use for them,
        which it learns from its garbage collection alone."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *frames: DataFrame) -> None:
        """Delete written tables that no later step reads."""
        for frame in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
