"""Distinct counts over many columns in one pass.

Every row becomes one (tag, value) pair for each counted column and one pair without a
value that carries the inputs of plain sums. Equal pairs are combined in the map tasks and
dealt by (tag, value), so the frame is read once and shuffled once, whatever the number
of columns, and a value that most rows share is one row for each map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG, VALUE, OCCURS = "_tag", "_value", "_occurs"
#: Tag of the pair that carries the summed inputs.
PLAIN = 0


def tagged(df: DataFrame, counted: dict[str, Column], summed: dict[str, Column]) -> DataFrame:
    """``_tag, _value, _occurs`` and the ``summed`` columns: a row for each distinct value of
    each counted column (tags from 1, in order; NULLs left out) with how often it occurs, and
    one row with tag 0 that holds the sums. Values are compared as text. An empty frame has
    no rows."""
    kinds = {f.name: f.dataType for f in df.select(*[c.alias(n) for n, c in summed.items()]).schema.fields} if summed else {}
    no_value, no_sums = F.lit(None).cast("string"), [F.lit(None).cast(k).alias(n) for n, k in kinds.items()]
    pairs = [F.struct(F.lit(PLAIN).alias(TAG), no_value.alias(VALUE), *[c.alias(n) for n, c in summed.items()])]
    pairs += [F.struct(F.lit(i + 1).alias(TAG), c.cast("string").alias(VALUE), *no_sums) for i, c in enumerate(counted.values())]
    rows = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    return (rows.filter((F.col(TAG) == PLAIN) | F.col(VALUE).isNotNull()).groupBy(TAG, VALUE)
            .agg(F.count(F.lit(1)).alias(OCCURS), *[F.sum(n).alias(n) for n in summed]))


def distinct_counts(df: DataFrame, counted: dict[str, Column], summed: dict[str, Column] | None = None,
                    rows: str | None = None) -> DataFrame:
    """One row: the number of distinct non-NULL values of each ``counted`` column, the sum of
    each ``summed`` one (NULL of no rows) and, under the name ``rows``, the number of rows."""
    summed = summed or {}
    one = tagged(df, counted, summed)
    outs = [F.max(F.when(F.col(TAG) == PLAIN, F.col(n))).alias(n) for n in summed]
    outs += [F.count_if(F.col(TAG) == i + 1).alias(n) for i, n in enumerate(counted)]
    if rows is not None:
        outs.append(F.coalesce(F.max(F.when(F.col(TAG) == PLAIN, F.col(OCCURS))), F.lit(0)).alias(rows))
    return one.agg(*outs)
