"""Registered queries of this subpackage and the SQL of those that SQL states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import (bpe, centroids, compress, decontaminate, exact_dedup, html_crf, licenses, near_dedup, quality, reshard, rules,
                         secrets, toxicity)
from cadenza.llm.common import read_table

OLD_SHARDS, NEW_SHARDS = 8, 8


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_points")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, *quality.train(docs, read_table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(licenses.sample_lines(docs)))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read_table(spark, sf_dir, "documents"), words=5, percent=75)


def op8_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.fit(pages))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read_table(spark, sf_dir, "documents"))


def op10_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old shards are the sources' files: a hot source makes them unequal."""
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(OLD_SHARDS))
    return reshard.reshard(read_table(spark, sf_dir, "documents"), old, OLD_SHARDS, NEW_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(read_table(spark, sf_dir, "documents"))


def op12_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress.compress(read_table(spark, sf_dir, "embeddings"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_bpe": op2_bpe,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_near_dedup": op6_near_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_html_crf": op8_html_crf,
    "op9_secrets": op9_secrets,
    "op10_reshard": op10_reshard,
    "op11_rules": op11_rules,
    "op12_compress": op12_compress,
    "op13_centroids": op13_centroids,
}

SQL: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.SQL,
    "op11_rules": rules.SQL,
    "op12_compress": compress.SQL,
    "op13_centroids": centroids.SQL,
}
