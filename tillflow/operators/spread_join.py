"""Left joins whose NULL and hot keys are spread over many tasks, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
#: Tasks that rows without a key are dealt to, at most.
NULL_SALTS = 1024
#: Rows of one key that meet their dimension row in one task, about.
ROWS_PER_TASK = 2_000_000
#: At most so many keys are split: those with a larger share than one in this number.
MOST_HOT = 1000


def hot_keys(dim: DataFrame, key: str, lines: Column, rows_per_task: int = ROWS_PER_TASK) -> dict:
    """``key -> copies`` for the keys that the dimension says have many fact lines. At most
    ``MOST_HOT`` keys, each with more than that share of all lines; all others fit a task
    or are left to the adaptive skew handling. Reads the dimension only."""
    known = dim.select(F.col(key).alias("k"), lines.alias("n")).filter(F.col("k").isNotNull())
    total = known.agg(F.sum("n")).first()[0] or 0
    least = max(rows_per_task, total // MOST_HOT)
    return {r.k: int(1 + r.n // rows_per_task) for r in known.filter(F.col("n") > least).collect()}


def left_join_spread(facts: DataFrame, dim: DataFrame, key: str, hot: dict | None = None) -> DataFrame:
    """``facts`` left join ``dim`` on ``key``; ``dim`` has one row for each key.

    The join is on (key, salt). A row without a key never matches; its salt is a hash of
    its other columns, so such rows, often a large share, spread over the tasks in place of
    all hashing to one. Keys of ``hot`` are split over ``copies`` salts and their
    dimension row is copied to each. All other rows have salt 0. The salt depends on the
    row alone, so a task that runs again deals its rows alike. The fact is read once."""
    others = [F.col(c) for c in facts.columns if c != key]
    spread = F.xxhash64(*others) if others else F.lit(0)
    null_salt = F.pmod(spread, F.lit(NULL_SALTS)).cast("int")
    if hot:
        pairs = [F.lit(x) for k, n in sorted(hot.items()) for x in (k, n)]
        copies = F.coalesce(F.element_at(F.create_map(*pairs), F.col(key)), F.lit(1))
        salt = F.pmod(spread, copies).cast("int")
        copied = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), copies - 1)))
    else:
        salt, copied = F.lit(0), dim.withColumn(SALT, F.lit(0))
    left = facts.withColumn(SALT, F.when(F.col(key).isNull(), null_salt).otherwise(salt))
    return left.join(copied, [key, SALT], "left").drop(SALT)
