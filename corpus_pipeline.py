"""Training-data pipeline over ``documents``: quality, near-duplicates, benchmark
contamination, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import attention_mil, chosen_path, drop_rows, fm_decontam, vector_packing, weak_pii
from tidewatch.session import cut_lineage

ORACLE_SQL = None  # no stage is a SQL query: models, joins by random paths, tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier accepts (score of 0.5 or more)."""
    model = attention_mil.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return attention_mil.score(docs, model, out="_score").where("_score >= 0.5").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): the smallest id."""
    verdicts = cut_lineage(chosen_path.near_duplicates(docs, width=5, num=80, den=100), "dedup")
    return drop_rows.one_of_each(docs, verdicts)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated: fewer than 1 in 20 words inside benchmark windows."""
    found = fm_decontam.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return fm_decontam.verdicts(found).where(~F.col("contaminated")).select(*docs.columns)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text."""
    masked = weak_pii.mask_documents(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with their ids."""
    return vector_packing.pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mask_pii", mask_pii), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
