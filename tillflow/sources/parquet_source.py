"""Order lines landed as Parquet (or any typed table).

Columns keep their stored types (the clean step coerces text, numbers and
timestamps alike); text columns get the reader's missing-value tokens. File
order for the keep-last dedup is exact here: Parquet scans expose each row's
position in its file as ``_metadata.row_index``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillflow.functions import na_tokens_to_null
from tillflow.sources.csv_source import ExtractionError, validate_schema


def read_source_parquet(spark: SparkSession, path, schema=None) -> DataFrame:
    """Source columns plus ``_ord`` = (file path, row index in the file).
    ``schema`` (DDL or StructType) skips footer inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.parquet(*(path if isinstance(path, (list, tuple)) else [path]))
    except Exception as e:  # noqa: BLE001
        raise ExtractionError(f"Failed to read Parquet source: {e}") from e
    validate_schema(df.columns)
    cols = [na_tokens_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"))
    return df.select(*cols, order.alias("_ord"))
