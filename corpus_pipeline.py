"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm.decontaminate import drop_leaks
from shelfwatch.llm.jaccard import jaccard_components
from shelfwatch.llm.packing import pack
from shelfwatch.llm.pii import redact
from shelfwatch.llm.queries import remainder, table
from shelfwatch.llm.storage import Scratch
from shelfwatch.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5, learned from the labels of the learning rows.

    Columns of any name, those of the score too, come out as they went in.
    """
    # Other names than the score's; every column goes through the scorer once.
    plain = [c if c in ("doc_id", "text") else f"kept{k}" for k, c in enumerate(docs.columns)]
    scored = toxicity(spark, docs.toDF(*plain), table(spark, sf_dir, "labels"), F.coalesce(remainder(5) != 0, F.lit(False)))
    return scored.where("predicted = 0").select(*plain).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): that with the smallest id.

    Documents without words are in no group and stay, as do documents without an id.
    """
    found = jaccard_components(spark, docs, words=5, percent=80)
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited."""
    return drop_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; ``n_chars`` follows the text."""
    clean = redact(docs)
    return clean.select(*[F.char_length("text").cast("bigint").alias(c) if c == "n_chars" else c for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]

# Learned models and an alignment decide what stays; SQL can't express them. Tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again; a stage's input goes when its output is there."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        done = scratch.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            scratch.drop(docs)
        docs = done
    return docs
