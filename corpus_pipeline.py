"""A training-data pipeline over `documents`: quality, near-duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of `documents`; the last returns packed pieces. A document that
holds a benchmark passage is left out; personal data are replaced by their kind in angle
brackets, and n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import _shared, chosen_path, cotraining, decontaminate, packing, pii


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject."""
    scored = cotraining.scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), score_col="_quality")
    return scored.filter(F.col("_quality") >= cotraining.THRESHOLD).drop("_quality")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return chosen_path.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced."""
    return pii.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    return packing.pack_documents(docs, keep_ids=False)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("personal_data", personal_data), ("best_fit_packing", best_fit_packing)]
#: No SQL: models, tokenisation and packing; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = _shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
