"""From raw documents to encoded training text: five stages, each written as Parquet and read again by the next.

Stages keep the columns of ``documents``; the last adds the encoding:

1. language: a document is rejected if no language fits it: it has no letter, or
   its score is below ``LEAST_SCORE``.
2. lines: lines that recur in distinct texts or contexts leave the texts, and n_chars follows; a document of
   which nothing but white space is left, though there was more, goes.
3. near duplicates, at a similarity of 0.8: one document of each group stays, the one with the smallest
   doc_id. Of repeated rows under that id all stay, as they are one document.
4. decontamination: documents that hold a benchmark item go.
5. encoding: n_tokens, and the SHA-256 of the ids and of the text decoded from them.

A NULL text has no letter and goes at the first stage. Empty tables stay empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.llm.bpe import byte_vocabulary, encode
from tellerflow.llm.decontamination import decontaminate
from tellerflow.llm.langid import UNKNOWN, identified
from tellerflow.llm.lines import drop_lines
from tellerflow.llm.neardup import near_duplicates
from tellerflow.session import shared_dir

LEAST_SCORE = 0.2
NEAR_PERCENT = 80  # of five-word shingles


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = identified(docs, keep=tuple(docs.columns), names=("_language", "_language_score"))
    return known.where((F.col("_language") != UNKNOWN) & (F.col("_language_score") >= LEAST_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = drop_lines(docs).where((F.col("n_dropped") == 0) | F.col("text").rlike("[^\\x09-\\x0D\\x20]"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Ids that stay; rows with a NULL id stay when nothing in their group has one.
    kept = near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, byte_vocabulary(), keep=tuple(docs.columns), digests=True)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near), ("decontamination", benchmark), ("encoding", encoding)]

# Learned profiles, the vocabulary's merges and edit distances to passages are beyond SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
    return docs
