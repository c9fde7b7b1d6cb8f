"""The corpus pipeline: stages applied to ``documents`` one after the other.

Every stage works on all rows the one before it kept, and is written as Parquet
and read again, so a lost executor costs at most one stage.  Repeated rows count
once after near-duplicate removal and may come back as copies from mixing; rows
without an id or text go through, with the results the operators define for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalog import Catalog
from larder.llm import decontaminate, mixing, near_dup, token_files, toxicity
from larder.llm.common import read_table
from larder.llm.queries import tokenizer
from larder.session import scratch_path

catalog = Catalog()


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, similarity 0.8."""
    return near_dup.keep_one(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out to bring the sources to their target weights."""
    return mixing.replicate(docs).select(*[f"`{c}`" for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids go to binary files; one row per document read back from them."""
    return token_files.token_files(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", contaminated),
    ("mixing", mixed),
    ("token_files", tokens),
]

ORACLE_SQL = None  # SQL can express neither the model nor the sketches, alignment and files


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


@catalog.query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
