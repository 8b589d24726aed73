"""The registered queries of the operators, and their SQL where DuckDB can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm import forest, lmscore, mixing, negatives, ngramjoin, quality, repeats, repetition, sharding, spm, threshold, tokenstore, toxicity
from tallygrid.llm.common import table
from tallygrid.llm.oracles import HARD_NEGATIVES, HIGHEST, MIXING


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.scores(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_removed(table(spark, sf_dir, "documents"))


def op5_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.stored_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.similarity_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op11_threshold_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold.highest(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return negatives.hard_negatives(rows.withColumn("label", negatives.moved_label(F.col("label"), F.col("vec_id"))))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.run_digests(repetition.with_runs(table(spark, sf_dir, "documents"), repetition.repeated_tail))


QUERIES = {q.__name__: q for q in (op1_toxicity, op2_lm_scores, op3_mixing, op4_repeats, op5_hash_forest, op6_sentencepiece, op7_token_store, op8_ngram_join, op9_sharding, op10_quality_rules, op11_threshold_top, op12_hard_negatives, op13_periodic_runs)}
SQL = {"op3_mixing": MIXING, "op11_threshold_top": HIGHEST, "op12_hard_negatives": HARD_NEGATIVES}
