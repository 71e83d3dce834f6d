"""The training-data pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docsink.llm.decontamination import drop_contaminated
from docsink.llm.exact_dedup import exact_dedup
from docsink.llm.minhash import drop_near_duplicates
from docsink.llm.packing import pack
from docsink.llm.toxicity import drop_toxic, train
from docsink.plans.tables import table, work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of what is left."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("exact dedup", without_copies),
    ("near duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Training a classifier and minwise hashing are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = work_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
