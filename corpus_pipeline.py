"""A training-corpus pipeline over `documents`: filter, dedup, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; run() writes every stage's rows to the shared folder and reads
them again, so that a lost executor costs no more than its stage.

In every stage a null text is an empty text, rows with equal or null doc_id are
rows of their own, other columns than those of documents are left out, and an
empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm import bpe, lines, mixing, near_dedup, quality
from gridlark.llm._shared import Scratch, temporary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the distribution rules reject; one without words is rejected."""
    return quality.quality_rules(docs).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that ten documents or more have; n_chars follows the text. A document that loses all lines stays, with an empty text."""
    out = lines.dedup_lines(docs, min_docs=10)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, similarity 0.8), that with the smallest doc_id; all without words stay."""
    return near_dedup.drop_near_copies(docs).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's weight asks for; a null source is a source of its own."""
    return mixing.emit_mix(docs).select(*COLUMNS)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian 32-bit) and the decoded text's SHA-256."""
    out = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("bpe_encode", bpe_encode),
]

#: SQL does not express BPE; tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the tables between are deleted when the next one is written."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES:
        with temporary():
            docs = scratch.save(stage(spark, docs, sf_dir))
        scratch.drop(*before)
        before = [docs]
    return docs
