"""The landing table of replies, and which of them are usable.

One row per reply; which key columns are filled depends on the endpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANDING = T.StructType(
    [
        T.StructField("endpoint", T.StringType()),
        T.StructField("source_text", T.StringType()),  # catalog, queries
        T.StructField("source_kind", T.StringType()),  # queries: "category" or "query"
        T.StructField("shard", T.StringType()),  # page
        T.StructField("query", T.StringType()),  # page
        T.StructField("page", T.IntegerType()),  # page
        T.StructField("sku", T.IntegerType()),  # seller
        T.StructField("code", T.IntegerType()),
        T.StructField("body", T.StringType()),
        T.StructField("snapshot_ts", T.TimestampType()),
        T.StructField("ingest_seq", T.LongType()),  # order of arrival, breaks ties
    ]
)

# Reply codes an endpoint may answer with.
ACCEPTED_CODES = {
    "catalog": (200,),
    "page": (200, 400, 404),
    "categories": (200,),
    "queries": (200,),
    "seller": (200, 404),
    "stocks": (200,),
}


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(LANDING).format(fmt).load(path).select(*LANDING.names)


def append_landing(landing: DataFrame, path: str) -> None:
    """Store replies so that a run reads the snapshot and endpoints it needs and nothing else."""
    landing.select(*LANDING.names).write.mode("append").partitionBy("snapshot_ts", "endpoint").parquet(path)


def stream_landing(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    stream = spark.readStream.schema(LANDING).format(fmt).options(**options).load(path)
    return stream.select(*LANDING.names)


def accepted() -> Column:
    """True for a reply with a known endpoint and an allowed code; never null."""
    ok = F.lit(False)
    for endpoint, codes in ACCEPTED_CODES.items():
        ok = ok | ((F.col("endpoint") == endpoint) & F.col("code").isin(*codes))
    return F.coalesce(ok, F.lit(False))


def replies(landing: DataFrame, endpoint: str) -> DataFrame:
    """Usable replies of one endpoint."""
    return landing.where((F.col("endpoint") == endpoint) & F.col("code").isin(*ACCEPTED_CODES[endpoint]))


def request_key() -> Column:
    """Printable request key, for rejects."""
    return F.concat_ws(
        " ",
        F.col("source_kind"), F.col("source_text"), F.col("shard"), F.col("query"),
        F.col("page").cast("string"), F.col("sku").cast("string"),
    )


def reject(df: DataFrame, stage: str, reason: Column | str, request: Column | None = None) -> DataFrame:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return df.select(
        "snapshot_ts",
        F.lit(stage).alias("stage"),
        reason.alias("reason"),
        (request_key() if request is None else request).alias("request"),
        "ingest_seq",
    )


def refused_replies(landing: DataFrame) -> DataFrame:
    """Replies with an unknown endpoint or a code that is not allowed."""
    return reject(
        landing.where(~accepted()),
        "landing",
        F.concat_ws(" ", F.lit("code"), F.col("code").cast("string"), F.lit("for"), F.col("endpoint")),
    )


def read_warehouse_file(spark: SparkSession, path: str) -> DataFrame:
    """First line of the warehouse list, one row ``body``."""
    return spark.read.text(path, wholetext=True).select(
        F.element_at(F.split("value", "\r\n|\n|\r"), 1).alias("body")
    )
