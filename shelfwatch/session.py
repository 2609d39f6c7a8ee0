"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime settings the operators count on. Partition counts and sizes stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Microsecond times keep row-group statistics; the older 96-bit form has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A task writes its few snapshots and endpoints side by side; beyond so many it sorts its rows, bodies and all.
    "spark.sql.maxConcurrentOutputFileWriters": "24",
    # Rows that go to Python wait outside the heap; 10,000 long texts would take ten times as much for each task.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # A menu may have any number of nodes; the default stops at a million.
    "spark.sql.cteRecursionRowLimit": "-1",
    # Nor is its depth bounded.
    "spark.sql.cteRecursionLevelLimit": "-1",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "shelfwatch", cores: int | str = "*", partitions: int = 8, memory: str = "8g"):
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores, such as one small file, to all of them.

    For CPU-heavy work per row; a table of many splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def literal_row(spark: SparkSession, schema: T.StructType, values: dict) -> DataFrame:
    """One row that is planned as a constant, without a Python worker."""
    columns = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 1, 1, 1).select(*columns)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return literal_row(spark, schema, dict.fromkeys(schema.names)).where(F.lit(False))


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """New folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary folder, once per session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="shelfwatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
