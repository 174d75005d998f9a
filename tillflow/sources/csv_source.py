"""Order-line CSV source.

* Every field is read as text: the schema is built from the file's own header
  (a user schema binds by position, so it must come from the header), and
  types are assigned later by the clean step, never inferred.
* Doubled quotes inside quoted fields are unescaped (``escape='"'``).
  A file read with ``multi_line`` may hold newlines inside quotes but is one split.
  Rows that leave a quote open are flagged (``_open_quote``), so that a reader can split
  all files and read only those again whole (``open_quote_files``).
* The reader's missing-value tokens (NA, N/A, NULL, nan, ...) become NULL.
* Each row carries ``_ord`` = (file path, split start, position in split):
  an orderable stand-in for file order, taken at the scan before any shuffle.
* Rows with more fields than the header are flagged (``_overlong``) and carry
  their whole record (``_raw_record``); rows with fewer are padded with NULLs. Text that was not valid UTF-8 shows up as
  U+FFFD and is flagged (``_bad_text``); since U+FFFD may also be legal text,
  the bytes decide, which a read as ISO-8859-1 keeps. The flags are counted as observed metrics during the first
  pass over the data; only a suspicious source is read once more.
* Files whose header differs from the first one's fail the read: a schema
  binds by position, so their columns would be swapped.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.config import SOURCE_COLUMNS
from tillflow.functions import na_tokens_to_null

EXPECTED_COLUMNS = frozenset(SOURCE_COLUMNS)
CORRUPT_COL = "_corrupt_record"
OVERLONG_COL = "_overlong"
BAD_TEXT_COL = "_bad_text"
OPEN_COL = "_open_quote"
RECORD_COL = "_raw_record"
UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"
REPLACEMENT_CHAR = "�"

# A quoted field (with doubled quotes inside), removed before counting commas. A
# quote opens a field only where the field starts; possessive, so a long field
# needs no stack.
_QUOTED_FIELD = r'(?<![^,])"[^"]*+(?:""[^"]*+)*+"'


class ExtractionError(Exception):
    """The source could not be read or does not have the expected shape."""


def _reader(spark: SparkSession, multi_line: bool, encoding: str):
    return (spark.read.option("header", True)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("encoding", encoding)
            .option("mode", "PERMISSIVE"))


def source_header(spark: SparkSession, path: str, multi_line: bool = False, encoding: str = UTF8) -> list[str]:
    """Column names from the header row (no type inference)."""
    try:
        return _reader(spark, multi_line, encoding).csv(path).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise ExtractionError(f"There is no source at {path}") from e
        raise ExtractionError(f"The source {path} cannot be read as CSV: {e}") from e


def validate_schema(columns) -> None:
    """The required columns must be present; extra columns are allowed."""
    missing = EXPECTED_COLUMNS - set(columns)
    if missing:
        raise ExtractionError(f"The source lacks the columns {sorted(missing)}; its header has {sorted(columns)}")


def field_count(raw: Column) -> Column:
    """Number of comma-separated fields of a raw CSV record."""
    return F.size(F.split(F.regexp_replace(raw, _QUOTED_FIELD, ""), ","))


def file_order() -> Column:
    """(file path, split start, increasing id within the split). Rows of one
    split are read in file order and the id grows within a task, so the
    struct orders rows as they appear in the files."""
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos"))


def text_schema(header) -> T.StructType:
    """All-text schema in header order plus the corrupt-record column."""
    return T.StructType([T.StructField(c, T.StringType()) for c in header]
                        + [T.StructField(CORRUPT_COL, T.StringType())])


def decorate(raw: DataFrame, header, order: Column | None = None) -> DataFrame:
    """Source columns with missing-value tokens nulled, plus ``_ord``,
    ``_overlong``, ``_bad_text``, ``_open_quote`` and ``_raw_record`` (NULL unless overlong), from a frame read with ``text_schema``
    (a batch read or a streaming micro-batch). ``order`` defaults to the
    file order from the scan's metadata."""
    corrupt = F.col(CORRUPT_COL)
    overlong = F.coalesce(corrupt.isNotNull() & (field_count(corrupt) > len(header)), F.lit(False))
    # the parser stops at the end of the line: too few fields of a record with an odd
    # number of quotes, or a last field that still has its opening one
    quotes = F.length(corrupt) - F.length(F.replace(corrupt, F.lit('"'), F.lit("")))
    open_quote = F.coalesce(corrupt.isNotNull() & (quotes % 2 == 1), F.lit(False)) | F.coalesce(
        F.startswith(F.col(f"`{header[-1]}`"), F.lit('"')), F.lit(False))
    bad_text = F.coalesce(F.concat_ws("", *[F.col(f"`{c}`") for c in header]).contains(REPLACEMENT_CHAR),
                          F.lit(False))
    return raw.select(
        *[na_tokens_to_null(F.col(f"`{c}`")).alias(c) for c in header],
        (file_order() if order is None else order).alias("_ord"),
        overlong.alias(OVERLONG_COL),
        bad_text.alias(BAD_TEXT_COL),
        open_quote.alias(OPEN_COL),
        F.when(overlong, corrupt).alias(RECORD_COL),
    )


def enforce_schema(header) -> bool:
    """Every file's header must match, unless the reader had to make up a name
    for a column without one."""
    return any(re.fullmatch(r"_c\d+", c) for c in header)


def source_reader(spark: SparkSession, header, multi_line: bool = False, encoding: str = UTF8):
    """Reader options of the source files (text schema from the header)."""
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    return (_reader(spark, multi_line, encoding).schema(text_schema(header))
            .option("enforceSchema", enforce_schema(header))
            .option("columnNameOfCorruptRecord", CORRUPT_COL))


def read_source_csv(spark: SparkSession, path, multi_line: bool | list[str] = False,
                    encoding: str = UTF8) -> DataFrame:
    """Source rows as text with ``_ord`` and the check columns.
    ``path`` is a file, folder, glob or list of them; ``multi_line`` holds for all files or
    for those of a list, the others are split. Needs whole-record
    parsing (``spark.sql.csv.parser.columnPruning.enabled`` false, set here
    and by the engine settings) for the field-count check."""
    first = path[0] if isinstance(path, (list, tuple)) else path
    header = source_header(spark, first, bool(multi_line), encoding)
    validate_schema(header)
    try:
        if not isinstance(multi_line, list):
            df = source_reader(spark, header, multi_line, encoding).csv(path)
            return decorate(df, header)
        every = source_reader(spark, header, False, encoding).csv(path).inputFiles()     # as URIs
        whole = {_plain(f) for f in multi_line}
        parts = [([unquote(f) for f in every if (_plain(f) in whole) == m], m) for m in (False, True)]
        frames = [decorate(source_reader(spark, header, m, encoding).csv(files), header) for files, m in parts if files]
        return reduce(DataFrame.unionByName, frames)
    except AnalysisException as e:
        raise ExtractionError(f"The source {path} cannot be read as CSV: {e}") from e


def _plain(file: str) -> str:
    """A file's path however its URI writes it."""
    return unquote(re.sub(r"^file:/+", "/", file))


def open_quote_files(source: DataFrame) -> list[str]:
    """Files of a source (as ``read_source_csv`` gives it) with rows that leave a quote open."""
    return sorted(x[0] for x in source.filter(F.col(OPEN_COL)).select("_ord.file").distinct().collect())


def list_files(spark: SparkSession, path) -> list[tuple[str, int, int]]:
    """``(path, length, change time)`` of the files of a path, folder, glob or list of them,
    in order, without the hidden ones that Spark's readers skip."""
    jvm, found = spark.sparkContext._jvm, []
    for p in [path] if isinstance(path, str) else path:
        root = jvm.org.apache.hadoop.fs.Path(p)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        open_ = list(fs.globStatus(root) or [])
        if not open_:
            raise ExtractionError(f"There is no source at {p}")
        while open_:
            s = open_.pop()
            if s.isDirectory():
                open_ += [x for x in fs.listStatus(s.getPath()) if not re.match(r"[._]", x.getPath().getName())]
            else:
                found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(set(found))


def not_utf8(latin: DataFrame) -> DataFrame:
    """Rows of a source read as ISO-8859-1, which keeps every byte, whose bytes
    are not UTF-8."""
    texts = [F.col(f"`{f.name}`") for f in latin.schema.fields if f.dataType == T.StringType() and f.name != RECORD_COL]
    return latin.filter(~F.is_valid_utf8(F.encode(F.concat_ws(",", *texts), LATIN1).cast("string")))


def check_metrics() -> list[Column]:
    """Aggregates to attach with ``DataFrame.observe`` on the source."""
    return [F.count_if(F.col(OVERLONG_COL)).alias("overlong_rows"),
            F.count_if(F.col(BAD_TEXT_COL)).alias("bad_text_rows"),
            F.count_if(F.col(OPEN_COL)).alias("open_quote_rows")]


def drop_check_columns(df: DataFrame, keep_record: bool = False) -> DataFrame:
    """Without the flags; ``keep_record`` leaves the records of overlong rows."""
    return df.drop(OVERLONG_COL, BAD_TEXT_COL, OPEN_COL, *([] if keep_record else [RECORD_COL]))


def has_check_columns(df: DataFrame) -> bool:
    return OVERLONG_COL in df.columns and BAD_TEXT_COL in df.columns


def detect_encoding(spark: SparkSession, path: str, multi_line: bool | list[str] = False) -> str:
    """UTF-8 unless the bytes of some row are not UTF-8, then ISO-8859-1 for
    the whole source (S3). A standalone probe (one pass that stops at the first
    bad row); the pipeline instead counts suspicious rows during its own pass
    and looks at the bytes only where it finds some."""
    df = read_source_csv(spark, path, multi_line=multi_line, encoding=LATIN1)
    return UTF8 if not_utf8(df).isEmpty() else LATIN1
