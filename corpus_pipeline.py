"""A corpus pipeline from raw documents to token files, one operator per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayline.llm import decontaminate, language, mixing, near_copies, token_files
from quayline.llm.common import shuffles_cleaned, small_batches, table
from quayline.session import configure, scratch_path

VOCABULARY = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undetermined or too close to call go."""
    return language.keep_identified(docs, language.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose five-word shingles agree to 0.8 or more: SimHash links, then the rest exactly."""
    return near_copies.keep_one(docs)


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled with the probabilities of the raked mixture."""
    return mixing.sample(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and one row per document read back from them."""
    manifest = token_files.write_tokens(docs, public_tokenizers.path(VOCABULARY), scratch_path(spark, "tokens"))
    return token_files.read_tokens(spark, manifest)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark_text),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: No SQL: compression, fingerprints over shingles and tokenization are outside of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        kept = stage(spark, docs, sf_dir)
        # Batches take room in the executors' JVMs as well, which they keep from stage to stage.
        with small_batches(spark), shuffles_cleaned(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
