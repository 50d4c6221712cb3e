"""CSV files with line breaks inside quotes, each read by many tasks.

A file is read as lines by byte ranges, as Spark splits any text.  A line break is a record's end where the number of quotes
before it is even (a doubled quote counts twice).  Each range tells whether its quotes are odd in number; the exclusive or of all ranges
before gives the state a range begins in, one row per range.  Most records are one line and need nothing else.  The lines of a longer
record, which may lie in several ranges, are put together under the range and number of its first line.

Files must follow RFC 4180: a quote inside a field that is not quoted would shift the state.  A file that ends inside quotes is an
error, as is one whose header has other names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, ORDER, RECORD = "_src_file", "_ord", "_record"


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """_src_file, _ord (ascending in a file, 1 for its first record) and _record, the text of every record, header included."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_line"), F.pmod(quotes, F.lit(2)).alias("_odd"))
    here = W.partitionBy(FILE, "_range").orderBy("_line")
    before = here.rowsBetween(W.unboundedPreceding, -1)
    lines = lines.select(
        "value", FILE, "_range", "_odd", F.row_number().over(here).alias("_index"),
        F.pmod(F.coalesce(F.sum("_odd").over(before), F.lit(0)), F.lit(2)).alias("_inside"))
    earlier = W.partitionBy(FILE).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = lines.groupBy(FILE, "_range").agg(
        F.pmod(F.sum("_odd"), F.lit(2)).alias("_flips"),
        F.count_if(F.col("_inside") == 0).alias("_even"), F.count_if(F.col("_inside") == 1).alias("_uneven"),
        F.bool_or((F.col("_range") == 0) & (F.col("_index") == 1) & F.endswith("value", F.lit("\r"))).alias("_first"))
    ranges = ranges.withColumns({
        "_enters": F.pmod(F.coalesce(F.sum("_flips").over(earlier), F.lit(0)), F.lit(2)),
        "_open": F.pmod(F.sum("_flips").over(W.partitionBy(FILE)), F.lit(2)),
        "_returns": F.bool_or("_first").over(W.partitionBy(FILE))})
    ranges = ranges.withColumn("_starts", F.when(F.col("_enters") == 0, F.col("_even")).otherwise(F.col("_uneven")))
    begun = F.when(F.col("_starts") > 0, F.struct(F.col("_range").alias("owner"), F.col("_starts").alias("number")))
    ranges = ranges.withColumn("_last", F.last(begun, ignorenulls=True).over(earlier)).select(
        F.col(FILE).alias("_f"), F.col("_range").alias("_r"), "_enters", "_open", "_returns", "_last")
    met = lines.join(ranges, (F.col(FILE) == F.col("_f")) & (F.col("_range") == F.col("_r")))
    closed = F.when(F.col("_open") == 0, F.col("_inside")).otherwise(
        F.raise_error(F.concat(F.lit("quote without an end in "), F.col(FILE))))
    met = met.withColumn("_begins", F.pmod(closed + F.col("_enters"), F.lit(2)) == 0)
    met = met.withColumn("_number", F.sum(F.col("_begins").cast("long")).over(
        W.partitionBy(FILE, "_range").orderBy("_index")))
    order = F.col("_range") + F.col("_index")
    # a file whose first line ends in a carriage return and a line feed has that pair as its line break everywhere
    met = met.withColumn("value", F.when(F.col("_returns"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value")))
    whole = met.where(F.col("_begins") & (F.col("_odd") == 0)).select(FILE, order.alias(ORDER), F.col("value").alias(RECORD))
    own = F.struct(F.col("_range").alias("owner"), F.col("_number").alias("number"))
    parts = met.where(~(F.col("_begins") & (F.col("_odd") == 0))).select(
        FILE, F.when(F.col("_number") == 0, F.col("_last")).otherwise(own).alias("_of"), order.alias("_at"), "value")
    longer = parts.groupBy(FILE, "_of").agg(F.array_sort(F.collect_list(F.struct("_at", "value"))).alias("_lines")).select(
        FILE, F.col("_lines")[0]["_at"].alias(ORDER), F.array_join(F.col("_lines.value"), "\n").alias(RECORD))
    return whole.unionByName(longer).where(F.col(RECORD) != "")  # empty lines are no records


def read_quoted_csv(spark: SparkSession, path: str, names: Sequence[str], corrupt: str | None = None) -> DataFrame:
    """``names`` as nullable strings, _src_file and _ord of every record below the header.

    Short records are padded with NULL.  ``corrupt`` names a column with the text of records of another width.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"escape": '"', "multiLine": "true"}
    records = quoted_records(spark, path)
    header = F.from_csv(RECORD, ", ".join(f"`{n}` string" for n in names), options)
    same = F.lower(F.to_json(header)) == F.lower(F.to_json(F.struct(*[F.lit(n).alias(n) for n in names])))
    rows = records.where(F.when(F.col(ORDER) != 1, True).when(same, False).otherwise(
        F.raise_error(F.concat(F.lit("other column names in "), F.col(FILE))).cast("boolean")))
    if corrupt:
        schema, options = schema.add(corrupt, "string"), options | {"columnNameOfCorruptRecord": corrupt}
    fields = ", ".join(f"`{f.name}` string" for f in schema)
    return rows.select(F.from_csv(RECORD, fields, options).alias("_r"), FILE, ORDER).select("_r.*", FILE, ORDER)
