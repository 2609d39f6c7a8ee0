"""The contract queries of this subpackage over the driver's tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import chat, pii, sql
from shelfwatch.llm.covertree import embedding_links
from shelfwatch.llm.decontaminate import find_leaks
from shelfwatch.llm.jaccard import jaccard_components
from shelfwatch.llm.langid import identify
from shelfwatch.llm.linkgraph import judge_urls
from shelfwatch.llm.packing import pack
from shelfwatch.llm.pieces import encode
from shelfwatch.llm.resample import resample
from shelfwatch.llm.simplex import integer_kmeans
from shelfwatch.llm.suffixlm import suffix_scores
from shelfwatch.llm.toxicity import toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """crc32 of the document id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark, table(spark, sf_dir, "embeddings"))


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *pii.digests(found))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark, table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_suffix_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_scores(spark, table(spark, sf_dir, "documents"), remainder(7) == 2)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(spark, docs, F.coalesce(remainder(3) != 1, F.lit(False)))
    return found.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), control.alias("text"),
    )
    return chat.digests(chat.render(chat.fold(chat.events_of(turns.union(extra)))))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(spark, docs, table(spark, sf_dir, "labels"), F.coalesce(remainder(5) != 0, F.lit(False)))
    return scored.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        # Where the last piece ends, and how many bytes the pieces cover: all of the text.
        F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(0)).cast("bigint").alias("last_end"),
        F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("covered"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integer_kmeans(spark, table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_embeddings": (op1_embeddings, sql.OP1),
    "op2_leaks": (op2_leaks, None),
    "op3_personal_data": (op3_personal_data, None),
    "op4_packing": (op4_packing, None),
    "op5_urls": (op5_urls, sql.OP5),
    "op6_suffix_model": (op6_suffix_model, None),
    "op7_language": (op7_language, None),
    "op8_chat": (op8_chat, sql.OP8),
    "op9_jaccard": (op9_jaccard, sql.OP9),
    "op10_toxicity": (op10_toxicity, None),
    "op11_pieces": (op11_pieces, None),
    "op12_centroids": (op12_centroids, sql.OP12),
    "op13_resampling": (op13_resampling, sql.OP13),
}
