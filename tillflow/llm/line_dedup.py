"""Line dedup by site-relative frequency (native).

A line's frequency is the number of pages of its host that hold it, divided by
the host's page total. Lines above the boilerplate ratio are dropped from every
page of that host; all other lines stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import pack, unpack

MAX_RATIO = 0.05
#: A line on fewer pages than this is no boilerplate, however small its host.
MIN_PAGES = 5
#: Lines a broadcast may hold (16 bytes each); beyond it pages are joined by shuffle.
BROADCAST_LINES = 1_000_000


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _keys(text: Column) -> Column:
    """Distinct keys of a page's lines that are not blank."""
    lines = F.filter(F.split(text, "\n"), lambda l: F.trim(l) != "")
    return F.array_distinct(F.transform(lines, line_key))


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, key, pages, ratio)`` of the lines above the ratio.

    Counted in two steps, on the map side first, so a hot host or line reaches the
    shuffle as one row per task. A host has fewer such lines than its mean number
    of lines a page divided by the ratio."""
    pages = docs.select(F.col(host).alias("host"), _keys(F.col(text)).alias("keys"))
    counts = (pages.select("host", F.explode("keys").alias("key")).groupBy("host", "key")
              .agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages))
    totals = pages.groupBy("host").agg(F.count("*").alias("total")).withColumnRenamed("host", "total_host")
    joined = counts.join(totals, F.col("host").eqNullSafe(F.col("total_host")))
    return (joined.withColumn("ratio", F.col("pages") / F.col("total"))
            .where(F.col("ratio") > max_ratio).select("host", "key", "pages", "ratio"))


def dedup_lines(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with the boilerplate lines cut from ``text``, and ``n_lines`` and
    ``n_dropped``. Lines are compared without outer blanks; blank lines stay and
    are not counted as found. A page whose lines all go keeps its row, with the
    empty text.

    Null text: stays null, 0 lines, still a page of its host. Null host: one host.
    Repeated rows: each is a page. Empty table: empty result. Columns named like an
    output are replaced."""
    bad = boilerplate(docs, text, host, max_ratio, min_pages).select("host", "key").persist()
    by_host = bad.groupBy(F.col("host").alias("bad_host")).agg(F.collect_list("key").alias("bad"))
    packed = pack(docs, text=F.col(text), host=F.col(host))
    if bad.count() <= broadcast_lines:
        marked = (packed.join(F.broadcast(by_host), F.col("host").eqNullSafe(F.col("bad_host")), "left")
                  .withColumn("bad", F.coalesce("bad", F.array().cast("array<bigint>"))))
    else:
        marked = _by_shuffle(packed, bad)
    lines = F.split(F.col("text"), "\n")
    # the host's lines first cut down to those on this page
    marked = marked.withColumn("bad", F.array_intersect(_keys(F.col("text")), F.col("bad")))
    kept = F.when(F.size("bad") == 0, lines).otherwise(
        F.filter(lines, lambda l: (F.trim(l) == "") | ~F.array_contains(F.col("bad"), line_key(l))))
    marked = marked.withColumn("kept", kept)
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(n_lines)
    n_kept = F.when(F.col("text").isNull(), 0).otherwise(F.size("kept"))
    return unpack(marked, docs, **{text: F.array_join("kept", "\n"), "n_lines": n_lines.cast("int"),
                                   "n_dropped": (n_lines - n_kept).cast("int")}).select(
        *[c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


def _by_shuffle(packed: DataFrame, bad: DataFrame) -> DataFrame:
    """Marks pages without a broadcast: the keys of each distinct text, spread over
    the lines' own keys, meet the boilerplate there and come back by text."""
    spread = packed.select("host", F.xxhash64("text", "host").alias("page"), F.explode(_keys(F.col("text"))).alias("key"))
    b = bad.select(F.col("host").alias("bad_host"), F.col("key").alias("bad_key"))
    found = (spread.join(b, (F.col("key") == F.col("bad_key")) & F.col("host").eqNullSafe(F.col("bad_host")))
             .groupBy(F.col("page").alias("found_page")).agg(F.collect_set("key").alias("bad")))
    return (packed.join(found, F.xxhash64("text", "host") == F.col("found_page"), "left")
            .withColumn("bad", F.coalesce("bad", F.array().cast("array<bigint>"))))


def oracle_sql() -> str:
    return """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, lang, source FROM documents),
l AS (SELECT rid, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
c AS (SELECT source, trim(line) AS key, count(DISTINCT rid) AS pages FROM l WHERE trim(line) <> '' GROUP BY 1, 2),
n AS (SELECT source, count(*) AS total FROM d GROUP BY 1),
b AS (SELECT c.source, c.key FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source
      WHERE c.pages >= 5 AND c.pages / n.total > 0.05),
k AS (SELECT l.rid, l.pos, l.line, b.key IS NULL AS kept
      FROM l LEFT JOIN b ON trim(l.line) = b.key AND l.source IS NOT DISTINCT FROM b.source),
g AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (kept), '') AS text FROM k GROUP BY rid)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.text, '') END AS text,
       CAST(coalesce(n_lines, 0) AS INT) AS n_lines, CAST(coalesce(n_dropped, 0) AS INT) AS n_dropped
FROM d LEFT JOIN g ON d.rid = g.rid"""
