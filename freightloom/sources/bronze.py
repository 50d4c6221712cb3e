"""Raw extracts: CSV files to all-string tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.operators.keep_first import ORDINAL
from freightloom.schemas import FEEDS
from freightloom.sources import versions
from freightloom.sources.quoted import read_quoted_csv

STATUS = "table_name string, status string, row_count bigint, bad_records bigint, message string"
CORRUPT = "_malformed"
MESSAGE_CHARS = 500
QUOTED_FIELD = r'(?<=^|,)"(?:[^"]|"")*"(?=,|\s*\z)'


def _all_strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool, **options) -> DataFrame:
    reader = spark.read.schema(schema).options(header=True, multiLine=multiline, escape='"', **options)
    return reader.csv(path)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(header=True, escape='"').csv(path).columns


def read_bronze_csv(
    spark: SparkSession, path: str, table: str | None = None, multiline: bool = True, with_ordinal: bool = False,
    split: bool = False
) -> DataFrame:
    """Extract with every column a nullable string.

    The header names the columns; short rows are padded with NULL; quoted line breaks are allowed.
    With ``multiline`` alone one file is one task.  ``split`` reads each file by byte ranges and follows the quotes across
    them, for large files that keep to RFC 4180; ``multiline=False`` is for extracts without line breaks inside quotes.
    ``with_ordinal`` adds the file and the row order for keep-first deduplication.
    """
    names = list(FEEDS[table].columns) if table else csv_header(spark, path)
    df = marked_rows(spark, path, names, multiline, split).drop(CORRUPT)
    return df if with_ordinal else df.drop(*ORDINAL)


def marked_rows(spark: SparkSession, path: str, names: Sequence[str], multiline: bool = True, split: bool = False) -> DataFrame:
    """All rows with their file and order, and the text of those that have not one field per name."""
    if split:
        return read_quoted_csv(spark, path, names, CORRUPT)
    df = _csv(spark, path, _all_strings([*names, CORRUPT]), multiline, enforceSchema=False, columnPruning=False,
              columnNameOfCorruptRecord=CORRUPT)
    return df.withColumns({"_src_file": F.col("_metadata.file_path"), "_ord": F.monotonically_increasing_id()})


def too_long(columns: int) -> Column:
    """Whether the text of a row marked as malformed has more than ``columns`` fields."""
    return F.size(F.split(F.regexp_replace(CORRUPT, QUOTED_FIELD, ""), ",")) > columns


def overlong_rows(spark: SparkSession, path: str, columns: int, multiline: bool = True) -> DataFrame:
    """Rows with more fields than the header.  A plain read would cut them without a word.

    The reader marks rows of the wrong width; their text, freed of quoted fields, shows which are
    too long rather than short.
    """
    names = [f"c{i}" for i in range(columns)] + [CORRUPT]
    df = _csv(spark, path, _all_strings(names), multiline, columnPruning=False, columnNameOfCorruptRecord=CORRUPT)
    # the reader refuses a query of its marker column alone, hence the second column
    return df.filter(too_long(columns) & (F.coalesce("c0", F.lit("")) != CORRUPT))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def load_table(
    spark: SparkSession, path: str, out: str, table: str, multiline: bool = True, split: bool = False
) -> tuple[str, str, int, int, str | None]:
    """Replace one bronze table; (name, status, rows, bad rows, message).  A bad row stops the load of the table.

    The extract is read once: rows and over-long rows are counted while a new version is written, which becomes
    the table only if none is over-long.
    """
    if not _exists(spark, path):
        return table, "SKIPPED", 0, 0, f"no {path}"
    names, seen = FEEDS[table].columns, Observation()
    rows = marked_rows(spark, path, names, multiline, split).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(too_long(len(names))).alias("bad"))
    version = versions.stage(rows.drop(CORRUPT), out)
    counts = seen.get
    if counts["bad"]:
        versions.discard(spark, out, version)
        return table, "REJECTED", 0, counts["bad"], "rows with more fields than the header"
    versions.commit(spark, out, version)
    return table, "OK", counts["rows"], 0, None


def load_all(
    spark: SparkSession, source_dir: str, out_dir: str, multiline: bool = True, split: bool = False, at_once: int = 4
) -> DataFrame:
    """Full reload of the catalogue from ``<source_dir>/<table>.csv`` (a file or a folder of files), ``at_once`` tables at a time."""
    def load(table: str) -> tuple[str, str, int, int, str | None]:
        try:
            return load_table(spark, f"{source_dir}/{table}.csv", f"{out_dir}/{table}", table, multiline, split)
        except (Py4JJavaError, PySparkException) as error:
            return table, "FAILED", 0, 0, str(error)[:MESSAGE_CHARS]

    with ThreadPoolExecutor(at_once) as pool:
        return spark.createDataFrame(list(pool.map(inheritable_thread_target(spark)(load), FEEDS)), STATUS)
