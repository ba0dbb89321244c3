"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktlens.llm import jaccard_join, langid, line_dedup, mixing, packing


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language.  The classifier learns from docs' own labels and
    fills in ``lang`` where it is NULL; rejected are documents without a letter in their
    text (NULL and empty ones too).  Where no label can be learnt, ``lang`` stays as it is."""
    return langid.keep_known(docs, langid.fit(docs))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines common to several documents stay in one; the last holder keeps them."""
    return line_dedup.drop_lines(docs, counts=False).withColumn("n_chars", F.length("text").cast("long"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: its smallest doc_id."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.op3_packing(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", drop_common_lines),
    ("jaccard_join", one_of_each_class),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language scores, hashed draws and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
