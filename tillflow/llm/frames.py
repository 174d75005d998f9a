"""DataFrame helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import scratch_path

ROW = "row"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the Python workers of a session this package, once, as a zip that the
    driver serves; they need not share its folders."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    app = spark.sparkContext.applicationId
    if app in _shipped or not os.path.isdir(package):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tillflow-ship-"), "tillflow.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def pack(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``row`` beside working columns, so
    that no column name of the caller can clash with a working name."""
    return df.select(F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias(ROW),
                     *[c.alias(n) for n, c in columns.items()])


def unpack(packed: DataFrame, source: DataFrame, **outputs: Column) -> DataFrame:
    """The caller's columns followed by ``outputs``. An output replaces an input
    column of the same name (compared without case)."""
    taken = {n.lower() for n in outputs}
    kept = [F.col(f"{ROW}.{_quoted(c)}").alias(c) for c in source.columns if c.lower() not in taken]
    return packed.select(*kept, *[c.alias(n) for n, c in outputs.items()])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder. Cuts the lineage:
    a lost executor costs no more than a re-read."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of all training: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
