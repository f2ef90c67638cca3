"""The corpus pipeline: language ID, toxicity, near-duplicates, secrets, packing, each a stage over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tillroll.llm import langid, neardup, packing, secrets, toxicity
from tillroll.llm.batches import learnable
from tillroll.session import ship, stage

TOKENIZER = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told with enough certainty."""
    ship(spark)
    return langid.keep(docs, langid.fit(docs.where(learnable())))


def toxic_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the grammar does not call toxic."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep(docs, toxicity.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that of the least id."""
    ship(spark)
    return neardup.deduplicate(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; ``n_chars`` follows."""
    ship(spark)
    clean = secrets.redact(docs, secrets.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into windows; one row per piece."""
    ship(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic_content),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("packing", sequence_packing),
]

# Models and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
