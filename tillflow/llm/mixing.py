"""Mixing sources to target weights by weighted fair queueing (native).

Every source is a queue of its documents in a shuffled, repeatable order (MD5 of
the id). A source's target is its share of the budget; a document's virtual
finish time is the source's cumulative words up to its end divided by that
target, so at any virtual time all sources have sent the same part of their
targets. Documents are range-sorted by finish time and the stream is cut at the
total budget, which is virtual time 1.

The cumulative sums never gather a source in one task: documents are summed by
(source, first four digits of the shuffle key), those sums are accumulated, and
only rows that share both are ordered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import pack, unpack

#: A word is a run of characters other than ASCII white space (fixed by contract).
WORD = r"[^\x20\x09-\x0D]+"
#: Weights dealt to the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
#: No source, and so no document, is taken more often than this.
MAX_REPEATS = 3
#: Leading hex digits of the shuffle key that split a source for its running sum.
SPLIT_DIGITS = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size)`` -> the same with ``target``.

    Sources in code point order, null last, weigh ``weights`` in rotation and
    divide ``share`` of all sizes; a target stops at ``max_repeats`` times its
    source and the excess is shared again by weight (water filling: sources by
    cap over weight, full ones first). One row per source, so the unpartitioned
    windows order as many rows as there are sources."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "ord")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("ord") - 1) % len(weights) + 1).cast("int"))
    filled = (
        sizes.withColumn("ord", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.floor(F.sum("source_size").over(everything) * F.lit(share)))
        .withColumn("rate", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                    / F.sum("weight").over(onward))
    )
    level = F.first(F.when(F.col("fill") > F.col("rate"), F.col("rate")), ignorenulls=True).over(everything)
    return (filled.withColumn("level", level)
            .select("source", "source_size",
                    F.when(F.col("level").isNull(), F.col("cap").cast("double"))
                    .otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))).alias("target")))


def place_key() -> Column:
    """Hash that deals a row its place in its source: of the id, of the text without one."""
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")).cast("binary"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
        max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs`` (``doc_id, text, source`` and any others) in the order of the mix,
    with ``size``, ``source_size``, ``target``, ``finish`` (virtual finish time of
    the first copy) and ``taken`` (words the mix takes of it, repeats counted; 0
    where its turn comes after the cut). The document in service at the cut gives
    the part that still fits, so each source's ``taken`` adds up to its target,
    rounded.

    Null text: size 0. Null source: a source of its own, last. Equal ids: ordered
    by size; wholly equal rows may change places. Null id: a place by its text's hash. Empty table: empty result. Input
    columns named like an output are replaced."""
    base = pack(docs, doc_id=F.col("doc_id"), source=F.col("source"),
                size=F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
                key=place_key())
    base = base.withColumn("part", F.substring("key", 1, SPLIT_DIGITS))

    slim = docs.select("source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.substring(place_key(),
                                   1, SPLIT_DIGITS).alias("part"))
    parts = slim.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    ahead = (Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("ahead", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)))
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")),
                             weights, share, max_repeats)

    inside = (Window.partitionBy("source", "part").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = base.withColumn("upto", F.sum("size").over(inside)).alias("d")
    t, p = targets.alias("t"), parts.alias("p")
    lane = p.join(t, F.col("p.source").eqNullSafe(F.col("t.source"))).select(
        F.col("p.source").alias("lane_source"), F.col("p.part").alias("lane_part"), "ahead", "source_size", "target")
    placed = queued.join(lane, F.col("d.source").eqNullSafe(F.col("lane_source")) & (F.col("d.part") == F.col("lane_part")))

    end = F.col("ahead") + F.col("upto")
    cut = F.floor(F.col("target") + 0.5)
    start = end - F.col("size")
    taken = sum((F.least(F.greatest(cut - start - F.col("source_size") * e, F.lit(0)), F.col("size"))
                 for e in range(1, max_repeats)),
                F.least(F.greatest(cut - start, F.lit(0)), F.col("size")))
    finish = F.when(F.col("target") > 0, end / F.col("target"))
    out = unpack(placed, docs, size=F.col("size"), source_size=F.col("source_size"), target=F.col("target"),
                 finish=finish, taken=taken.cast("long"))
    return out.orderBy(F.col("finish").asc_nulls_last(), F.col("doc_id").asc_nulls_last())


def oracle_sql() -> str:
    """The same result in DuckDB SQL, with plain windows over whole sources."""
    return r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS ord FROM d GROUP BY source),
w AS (SELECT *, CASE (ord - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM s),
f AS (SELECT *, cap / weight AS fill, sum(source_size) OVER () AS budget FROM w),
r AS (SELECT *, CAST(budget - coalesce(sum(cap) OVER (ORDER BY fill, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
              / CAST(sum(weight) OVER (ORDER BY fill, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rate FROM f),
l AS (SELECT arg_min(rate, (fill, ord)) FILTER (fill > rate) AS level FROM r),
t AS (SELECT source, source_size,
             CASE WHEN level IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), level * weight) END AS target FROM r, l),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS cut,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(cut - (upto - size), 0), size)
          + least(greatest(cut - (upto - size) - source_size, 0), size)
          + least(greatest(cut - (upto - size) - 2 * source_size, 0), size) AS BIGINT) AS taken
FROM q"""
