"""Registered queries of the text operators, with production parameters, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from otif.llm import dac, decontam, divergence, minhash, packing, pii, quality, resample, secrets, sharding, substring, toxicity, urls
from otif.llm.common import read
from otif.llm.tokens import default_tokenizer

SHARDS = 24


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_runs(read(spark, sf_dir, "documents")).drop("row")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(read(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages")).drop("score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.token_files(read(spark, sf_dir, "documents"), default_tokenizer())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), default_tokenizer())


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_repeated_passages, op2_sharding, op3_url_filter, op4_quality_rules, op5_near_duplicates, op6_secrets,
              op7_decontamination, op8_token_files, op9_toxicity, op10_packing, op11_source_divergence, op12_resampling, op13_personal_data)
}

ORACLE: dict[str, str] = {"op4_quality_rules": quality.SQL, "op11_source_divergence": divergence.SQL, "op12_resampling": resample.SQL}
