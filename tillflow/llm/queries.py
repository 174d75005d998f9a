"""One query per operator, over its whole table, and the oracle SQL where SQL can
express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import scratch_path

from . import (decontamination, extraction, line_dedup, lm_scoring, mixing, near_dedup, periodic_runs, quality, ranked_search,
               token_counts, toxicity, vector_dedup, vector_search)
from .frames import written


#: A public byte-level BPE vocabulary as ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op2_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_balanced_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.duplicate_classes(table(spark, sf_dir, "documents"))


def op6_token_rollups(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """All documents enter with estimated counts; real counts then revise the estimates,
    documents without tokens are deleted (so ``documents`` counts those with tokens), and the
    first batch is sent once more."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    version = vocabulary.rsplit("/", 1)[-1].removesuffix(".tiktoken")
    counts = written(token_counts.count_tokens(docs, vocabulary, public_tokenizers.PATTERN, version), "counts")
    estimates = counts.withColumn("tokens", F.floor((F.col("chars") + 3) / 4))
    rollup = token_counts.Rollup(spark, scratch_path(spark, "llm-rollup"))
    rollup.commit("1-estimates", token_counts.signed(estimates, 1))
    rollup.commit("2-counts", token_counts.revised(estimates, counts))
    rollup.commit("3-empty", token_counts.signed(counts.where(F.col("tokens") == 0), -1))
    rollup.commit("1-estimates", token_counts.signed(estimates, 1))
    return rollup.totals()


def op7_toxicity_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op11_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.duplicates(table(spark, sf_dir, "embeddings"))


def op12_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_pseudo_likelihood, op2_quality_nbsvm, op3_balanced_lists, op4_decontamination, op5_order_minhash, op6_token_rollups,
    op7_toxicity_nearest, op8_line_dedup, op9_mixing, op10_wrappers, op11_pivot_permutation, op12_best_positions, op13_periodic_runs)}
ORACLE = {"op8_line_dedup": line_dedup.oracle_sql(), "op9_mixing": mixing.oracle_sql(),
          "op12_best_positions": ranked_search.oracle_sql()}
