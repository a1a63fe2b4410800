"""Corpus pipeline: quality filter, exact and near deduplication, benchmark
decontamination, token ids.

Each stage works on all rows that its predecessor kept, written to the shared
folder as Parquet and read again in between, and calls one operator of
``cadenza.llm``.  All but the last return the columns of ``documents``.

Defined cases follow the operators: null texts count as empty, repeated rows are
copies, null ids are kept where nothing else decides, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from cadenza.llm.common import read_table, saved
from cadenza.llm.queries import tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, *quality.train(docs, read_table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return near_dedup.drop_near_copies(docs, words=5, percent=75)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontaminate", benchmark_leaks),
    ("bpe", tokens),
]

#: Trained scores, shingle links, alignments and token ids are not SQL; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
