"""The registered corpus queries, each over its whole table, with SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalog import Catalog
from larder.llm import ann, block_dedup, decontaminate, filter_audit, html_text, importance, mixing, near_dup, pii, suffix_dedup, token_counts, token_files, toxicity
from larder.llm.common import read_table

catalog = Catalog()


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_DOCUMENT = "d.doc_id, d.text, d.lang, d.source, d.n_chars"


@catalog.query(mixing.replicate_sql(columns=_DOCUMENT))
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(read_table(spark, sf_dir, "documents"))


@catalog.query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@catalog.query()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@catalog.query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels))


@catalog.query()
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@catalog.query()
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), size=3, threshold=(85, 100))


@catalog.query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(read_table(spark, sf_dir, "documents")).drop("kept")


@catalog.query()
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


@catalog.query()
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


@catalog.query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.train(docs))


@catalog.query(filter_audit.AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@catalog.query(importance.RESAMPLE_SQL)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@catalog.query(block_dedup.REPEATED_SQL)
def op11_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_dedup.repeated_words(read_table(spark, sf_dir, "documents")).drop("kept")
