"""The corpus pipeline: language ID, line dedup, near-duplicate documents, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagwise.llm import language_id, line_dedup, ngram_join, pack, pii
from bagwise.llm.common import written
from bagwise.llm.queries import word_bpe


def measured(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; rows without text or id go."""
    found = language_id.languages(language_id.document_evidence(docs), language_id.labelled_documents(docs))
    return docs.join(found.filter("accepted").select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go, and documents that hold nothing else."""
    return measured(line_dedup.without_lines(docs, line_dedup.duplicate_lines(docs)).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies stays (five words, similarity 0.8)."""
    found = ngram_join.ngram_jaccard_components(docs, size=5, percent=80)
    copies = found.filter("doc_id != component_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return measured(pii.without_personal_data(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens from all that is left; a row for each piece."""
    return pack.harmonic_pack(docs, word_bpe(), keep_ids=False)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", packing)]

#: Models, tokenizers and graph components aren't expressed in SQL; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
