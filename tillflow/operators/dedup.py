"""Keep-last deduplication (D1) and its duplicate count.

Spark rows have no order, so every row carries an orderable ``order_col``
taken at the scan (file position for files, a total key order for tables).
The kept row per key is ``row_number() over (partition by keys order by
order_col desc) <= 1``. Spark plans this filter as a top-1 per group that runs
twice: a partial ``WindowGroupLimit`` in every map task before the shuffle and
a final one after it. So a key that holds a large share of all rows (for
example every row whose keys are all NULL, which group together) is cut to
one row per map task before it is shuffled, and the reducer sees at most one
row per map task for it. Sorts and the limit are code-generated.
``dropDuplicates`` keeps an arbitrary row and is not used.

The keys of the result depend on the rank. A filter on a plain key would be moved below
the window and the joins under it, with the whole cleaning of the column written out
once for each use in the filter and worked out anew for each line; so it reads the
cleaned value, and every model over the same lines shares one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.config import DEDUP_KEYS

_RN = "_keep_rank"


def dedup_keep_last(df: DataFrame, order_col: str = "_ord", keys=DEDUP_KEYS) -> DataFrame:
    """One row per ``keys`` (NULLs compare equal): the row with the greatest
    ``order_col``. The order column is dropped."""
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    kept = F.col(_RN) <= 1
    return (df.withColumn(_RN, F.row_number().over(w))
            .filter(kept)
            .withColumns({k: F.when(kept, F.col(k)) for k in keys})
            .drop(_RN, order_col))


def duplicate_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """D2 as one row: rows before, rows after, rows removed. The two counts
    are unioned and folded into one row (no join)."""
    both = (before.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("before"))
            .unionByName(after.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("after"))))
    b = F.sum(F.when(F.col("side") == "before", F.col("n")))
    a = F.sum(F.when(F.col("side") == "after", F.col("n")))
    return both.agg(b.cast("long").alias("rows_before"), a.cast("long").alias("rows_after"),
                    (b - a).cast("long").alias("duplicates_removed"))
