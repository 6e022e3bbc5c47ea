"""From raw documents to packed sequences: quality, near-copies, benchmark leaks, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before it kept;
its result is written as Parquet to the shared folder and read again as the next one's documents.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewise.llm import decontaminate, nearcopies, packing, quality, secrets
from linewise.llm.stored import stored
from linewise.llm.wordids import default_tokenizer
from linewise.session import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits or the trees reject go."""
    ship_package(spark)
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays (five words, similarity 0.8)."""
    ship_package(spark)
    return nearcopies.first_of_each(docs, width=5, num=80, den=100)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, within its edit budget, go."""
    ship_package(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in their documents; examples that many owners hold stay where they do not look live."""
    ship_package(spark)
    return secrets.mask(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    ship_package(spark)
    return packing.pack(docs, default_tokenizer(), size=2048, end_id=0)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Trees, edit distances and tokens are beyond SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
