"""The corpus pipeline: documents to packed training sequences.

Every stage but the last returns the columns of its input; rows that repeat
pass or go together, empty tables pass as empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import jaccard, language, line_dedup, packing, quality
from episodica.llm.common import crc_mod, table, written

# A language is taken if its score is at least this: 99.5% of the right predictions on 2,499 held-out texts of sf0.1
# reach it. Languages that were never learned and letter junk lead by less.
LEAST_LANGUAGE_SCORE = 0.97


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from two thirds of the labels."""
    learn = crc_mod("doc_id", 3) != 1
    model = quality.fit(*quality.training_rows(docs, table(spark, sf_dir, "labels"), learn))
    return docs.where(quality.probability(model) >= quality.ACCEPT_AT)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from the given ``lang``."""
    model = language.fit(*language.training_rows(docs, crc_mod("doc_id", 4) != 2))
    # Texts without a letter have the score 0.
    return docs.where(language.identified(model)["score"] >= LEAST_LANGUAGE_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that an earlier one holds; those that are left empty go.

    ``n_chars`` follows the text.
    """
    names = docs.columns
    out = line_dedup.dedup(docs)
    out = out.where(~((F.size("removed") > 0) & (F.col("text") == "")))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        same = F.size("removed") == 0
        out = out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by similar n-grams."""
    gone = written(jaccard.join(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct(), "near_copies")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_copies),
    ("packing", pack_documents),
]

# Trained classifiers and MinHash have no SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
