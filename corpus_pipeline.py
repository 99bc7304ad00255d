"""The corpus pipeline: documents through the stages of STAGES, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketlake.llm import decontamination, jaccard_join, quality_rules, source_mixing, token_output
from docketlake.llm.common import read, scratch


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_rejected(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a document taken twice has two rows."""
    return source_mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in the shared folder; the result is read back from them, a row for each row of the mix."""
    import public_tokenizers

    return token_output.read_shards(token_output.write_shards(docs, scratch(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", reject_low_quality),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_test_items),
    ("source_mixing", mix_sources),
    ("token_output", write_tokens),
]

#: The stages estimate models and write binary files, which SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
