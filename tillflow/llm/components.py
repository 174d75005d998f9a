"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(u, v)`` long ids -> ``(node, label)`` for every node that has an edge; the
    label is the smallest id of its component.

    Each round replaces a node's edges by edges to the smallest id it can see, so
    paths shorten by halves. Minima are aggregated on the map side and joins on a hub
    may be split, so no task has to hold the neighbours of one node. Every round is
    written to the shared folder."""
    now = written(edges.where(F.col("u") != F.col("v"))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = _print(now)
    while True:
        now = written(_small(_large(now)), name)
        after = _print(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _least(edges: DataFrame, key: str, other: str) -> DataFrame:
    return edges.groupBy(F.col(key).alias("at")).agg(F.min(other).alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, "u", "v").select("at", F.least("at", "m").alias("m"))
    joined = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("at"))
    return joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = _least(edges, "u", "v")
    joined = edges.join(least, F.col("u") == F.col("at"))
    return (joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select(F.col("at").alias("u"), F.col("m").alias("v")))).distinct()
