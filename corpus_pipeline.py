"""The text pipeline: language, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept and returns a DataFrame, which
is written and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crownframe.llm import exact_dedup, language_id, near_copies, pattern_packing
from crownframe.session import cut


#: Words a worker remembers while it packs, and rows handed to a worker at a time: one worker serves all stages, and what
#: one stage held is not all given back before the next.
WORDS, BATCH = 120_000, 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language: no letters, or no label at a score of 0.5."""
    small_batches(spark)
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts, that of the largest doc_id."""
    small_batches(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that of the smallest doc_id: SimHash groups of five-word shingles and
    every other pair that shares a band of MinHash values, each link confirmed by a Jaccard similarity of 0.8."""
    small_batches(spark)
    return near_copies.keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the pieces of all that is left in sequences."""
    small_batches(spark)
    return pattern_packing.pack(docs, remembered=WORDS)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("pattern_packing", packing)]

#: Bayes scores, shingle sets and tokenizers aren't SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
