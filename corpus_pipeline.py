"""The corpus pipeline: five stages over ``documents``, each written as Parquet and
read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import decontamination, line_dedup, mixing, near_dedup, quality
from tillflow.llm.frames import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores as good; every row is scored by its own text."""
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines; ``n_chars`` follows the text."""
    cut = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, in its order; ``taken`` counts a document's words in
    the mix, repeats included."""
    return mixing.mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_site_lines),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k + 1}")
    return docs


#: Classifier, signatures and fingerprints have no SQL form; tests compare with brute force.
ORACLE_SQL = None
