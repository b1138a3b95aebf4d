"""The corpus pipeline: stages over documents, each reading what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldcube.llm import bpe, language_id, line_dedup, mixing, ngram_join
from veldcube.llm.common import WORD, stored

#: The stages hold models and similarity joins, which SQL cannot express.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.known_language(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line that is nearly alike elsewhere in its first place only; documents that consist of
    such lines and blank ones alone, which are copies, go."""
    emptied = (F.col("__removed") > 0) & ~F.col("text").rlike(WORD)
    kept = line_dedup.deduplicated(docs, n_removed="__removed").filter(~emptied).drop("__removed")
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles make."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the text they decode to."""
    return bpe.encode(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("source mixing", mix_sources),
    ("BPE encoding", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
