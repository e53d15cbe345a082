"""Corpus pipeline: each stage takes the documents its predecessor kept.

Every function takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``, the last one the drawn mixture
(doc_id, source, n_tokens, epoch, order_key, block).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreports.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_rules
from fieldreports.llm.shared import new_path, stored, temporary_tables
from fieldreports.session import remove_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line equals or nearly equals."""
    cut = line_dedup.dedup_lines(docs, blocks=True)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target mix of sources."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("source mixing", mixing_stage),
]

# Compression ratios and edit distances have no SQL form here; the tests compare
# each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table; each result is written and read again.

    The tables a stage writes on its way go when its result is written, and a result goes
    when the next one is. The last result kept is what the returned rows are read from.
    """
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = new_path(spark)
        with temporary_tables(spark):
            docs = stored(stage(spark, docs, sf_dir), path)
        if folder is not None:
            remove_path(spark, folder)
        folder = path
    return STAGES[-1][1](spark, docs, sf_dir)
