"""The cleaning pipeline: each stage works on what its predecessor kept and returns the columns of documents, the last its bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import exact_dedup, language, packing, pii, simhash
from ledgerlens.llm.common import DOCUMENT_COLUMNS, staged

#: A text that the best language codes no better than plain bytes is no text of any known language.
MOST_BITS_PER_BYTE = 8.0


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENT_COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Set lang to the predicted one; texts without a language (und, or not coded better than plain bytes) go."""
    docs = _documents(docs)
    return language.label(docs, language.fit(docs), MOST_BITS_PER_BYTE)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id stays."""
    return exact_dedup.keep_one(_documents(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that five-word similarity of 0.8 or more connects, the one with the smallest doc_id stays."""
    docs = simhash.numbered(_documents(docs), "row")
    gone = staged(simhash.near_groups(docs, row_col="row").select(F.col("rid").alias("row")), "gone")
    return docs.join(gone, "row", "left_anti").select(*DOCUMENT_COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text is replaced by its kind."""
    docs = _documents(docs)
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their bins."""
    return packing.pack(_documents(docs))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]
#: SQL can't express the language, near-duplicate and boosting stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
