"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veldcube.llm import bpe, embedding_dedup, exact_dedup, fill_middle, html_text, language_id, line_dedup, mixing, ngram_join, secret_scan, token_links, vector_search, warc
from veldcube.llm.common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_report(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_report(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_report(table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.middle_report(table(spark, sf_dir, "documents"))


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(table(spark, sf_dir, "embeddings"))


def op13_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.links_report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_ngram_join": op2_ngram_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_text": op6_html_text,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_fill_middle": op11_fill_middle,
    "op12_vector_search": op12_vector_search,
    "op13_token_links": op13_token_links,
}
SQL = {
    "op1_mix_sources": mixing.MIX_REPORT_SQL,
    "op4_exact_dedup": exact_dedup.EXACT_SQL,
    "op8_warc": warc.WARC_SQL,
    "op11_fill_middle": fill_middle.MIDDLE_SQL,
}
