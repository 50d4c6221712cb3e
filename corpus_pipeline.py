"""A training corpus from raw documents: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.llm import bpe, decontaminate, quality
from freightloom.llm.common import kept, numbered, table, workspace
from freightloom.llm.exact_dedup import exact_dedup
from freightloom.llm.queries import tokenizer
from freightloom.llm.simhash import simhash_dedup


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of equal texts."""
    folder = workspace(spark)
    rows, row = numbered(docs, folder)
    gone = exact_dedup(rows, folder, row=row).where("NOT kept").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked fingerprints (three-word shingles, three bits)."""
    folder = workspace(spark)
    rows, row = numbered(docs, folder)
    gone = simhash_dedup(rows, folder, row).where("NOT kept").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their number."""
    return bpe.encode_documents(docs, tokenizer())


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: The classifier and the tokenizer have no SQL form; tests compare with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), workspace(spark)
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), folder, name)
    return kept(STAGES[-1][1](spark, docs, sf_dir), folder, STAGES[-1][0])
