"""Queries of the llm operators: each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pointloom.llm import chats, embeddings, licences, lm, mixing, packing, resample, simhash, spelling, suffix_dedup, syncmers, token_counts
from pointloom.llm.common import table
from pointloom.llm.toxicity import op10_toxicity as _toxicity


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op1_suffix_array(table(spark, sf_dir, "documents"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.op2_embeddings(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op3_packing(table(spark, sf_dir, "documents"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.op4_licences(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.op5_fingerprints(table(spark, sf_dir, "documents"))


def op6_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.op6_chats(table(spark, sf_dir, "conversations"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op7_mixing(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op8_simhash(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op9_token_counts(table(spark, sf_dir, "documents"))


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.op11_lm_scores(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op12_spelling(table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.op13_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ALL = {f.__name__: f for f in (op1_suffix_array, op2_embeddings, op3_packing, op4_licences, op5_fingerprints, op6_chats, op7_mixing, op8_simhash, op9_token_counts, op10_toxicity, op11_lm_scores, op12_spelling, op13_resampling)}

SQL: dict[str, str] = {"op7_mixing": mixing.OP7_SQL, "op12_spelling": spelling.OP12_SQL, "op13_resampling": resample.OP13_SQL}
